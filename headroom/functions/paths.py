"""Column functions over paths, item keys and unit properties."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of item keys and paths.
PATH = r"(/[A-Za-z0-9._@%+=:,~\-]+(?:/[A-Za-z0-9._@%+=:,~\-]+)*)"
FILESYSTEM = r"^vfs\.fs\.size\[(.*?),(.*?)\]$"
DEVICE = r"^vfs\.dev\.(read|write)\[(.*?)\]$"
INTERFACE = r"^net\.if\.[^(\[]+\[(.*?)(?:,.*)?\]$"
CERTIFICATE = r"^web\.certificate\.get\[(.+?)\]$"
UNIT = r"^systemd\.unit\.(?:get|info)\[(.*?)(?:,(.*?))?\]$"
PROCESSES = r"^proc\.num\[(.*)\]$"
SERVICE_HINTS = ("zabbix", "grafana", "victoria", "victoriametrics", "vminsert", "vmselect", "vmstorage", "vmagent", "vmalert", "vmauth", "postgres", "postgresql", "pgsql")

IGNORED = ("/proc/", "/sys/", "/dev/", "/run/", "/tmp/")
BARE = ("/", "/var", "/etc", "/usr", "/opt")


def _ends(low: Column, *ends: str) -> Column:
    out = F.lit(False)
    for e in ends:
        out = out | low.endswith(e)
    return out


def _starts(low: Column, *starts: str) -> Column:
    out = F.lit(False)
    for s in starts:
        out = out | low.startswith(s)
    return out


def _has(low: Column, *parts: str) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | low.contains(p)
    return out


# Kinds of paths by their ends, starts and parts, the first rule that holds.
Rule = tuple[str, tuple[str, ...], tuple[str, ...], tuple[str, ...]]
ITEM_RULES: tuple[Rule, ...] = (
    ("log_like", (".log", ".out", ".err"), ("/var/log/",), ()),
    ("config_like", (".conf", ".ini", ".yaml", ".yml", ".json", ".toml", ".cnf", ".service"), ("/etc/",), ()),
    ("certificate_like", (".crt", ".pem", ".key", ".cer"), ("/etc/ssl/", "/etc/pki/"), ("/cert",)),
    ("binary_like", (), (), ("/bin/", "/sbin/")),
    ("data_like", (), (), ("/var/lib/", "data", "pg_wal", "tablespace", "victoria-metrics-data")),
)
FILE_RULES: tuple[Rule, ...] = (
    ("cert_file", (".crt", ".cer", ".pem", ".der", ".key", ".p12", ".pfx"), (), ()),
    ("log_file", (".log",), (), ("/log/", "/logs/", ".log.")),
    ("config_file", (".conf", ".ini", ".cfg", ".yaml", ".yml", ".json", ".xml", ".properties", ".service", ".target", ".socket", ".timer", ".mount", ".slice"), ("/etc",), ()),
    ("binary_file", (".sh", ".py", ".pl", ".rb"), ("/bin/", "/sbin/", "/usr/bin/", "/usr/sbin/", "/usr/local/bin/", "/usr/local/sbin/"), ()),
    ("data_file", (), ("/var/lib", "/var/opt", "/var/www", "/srv", "/home", "/opt"), ()),
)
CERTIFICATE_RULES: tuple[Rule, ...] = (("certificate_like", (".crt", ".pem", ".key", ".csr", ".pfx", ".p12", ".cer"), (), ("ssl", "cert", "pki", "ca", "tls")),)
DUMP_RULES: tuple[Rule, ...] = (
    ("config", (), ("/etc",), ()),
    ("data", (), ("/var/lib", "/srv", "/data"), ()),
    ("binary", (), ("/usr/bin", "/usr/sbin", "/bin", "/sbin", "/opt"), ()),
)
DUMP_CERTIFICATES, DUMP_CERTIFICATE_PARTS, DUMP_LOGS = (".crt", ".pem", ".cer", ".key", ".pfx"), ("ssl", "pki", "certs", "cert"), (".log", ".gz", ".journal")


def kind_by(rules: tuple[Rule, ...], path: Column, other: Column) -> Column:
    """The kind of the first rule of which an end, a start or a part is that of the path."""
    out = other
    for kind, ends, starts, parts in reversed(rules):
        out = F.when(_ends(path, *ends) | _starts(path, *starts) | _has(path, *parts), kind).otherwise(out)
    return out


def safe_path(p: Column) -> Column:
    return p.startswith("/") & ~p.isin(*BARE) & ~_starts(p, *IGNORED)


def item_paths(*texts: Column) -> Column:
    """Distinct safe absolute paths of the texts, sorted."""
    found = F.concat(*[F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(PATH), F.lit(1)) for t in texts])
    return F.array_sort(F.array_distinct(F.filter(found, safe_path)))


def item_path_kind(p: Column) -> Column:
    return kind_by(ITEM_RULES, F.lower(p), F.lit("other"))


def certificate_kind(p: Column, kind: Column) -> Column:
    """certificate_like by extension or hint anywhere in the path, else the given kind."""
    return kind_by(CERTIFICATE_RULES, F.lower(F.coalesce(p, F.lit(""))), F.coalesce(kind, F.lit("")))


def file_kind(path: Column) -> Column:
    """Kind of a verified file."""
    return kind_by(FILE_RULES, F.lower(F.trim(F.coalesce(path, F.lit("")))), F.lit("other"))


def directory_kind(kind: Column) -> Column:
    known = ("log", "config", "cert", "binary", "data")
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(f"{k}_{x}") for k in known for x in ("file", "dir")]), kind), F.lit("other"))


def dump_kind(p: Column) -> Column:
    """Kind of a path of a command dump: certificate, log, config, data, binary, other."""
    suffix = F.lower(F.regexp_extract(F.regexp_extract(p, r"([^/]*)/*$", 1), r"^.+(\.[^.]+)$", 1))
    parts = F.transform(F.split(p, "/"), lambda x: F.lower(x))
    certificate = suffix.isin(*DUMP_CERTIFICATES) | F.arrays_overlap(parts, F.array(*map(F.lit, DUMP_CERTIFICATE_PARTS)))
    return F.when(certificate, "certificate").when(p.contains("var/log") | suffix.isin(*DUMP_LOGS), "log").otherwise(kind_by(DUMP_RULES, p, F.lit("other")))


def parent(p: Column) -> Column:
    """Directory of a path, by its text alone."""
    up = F.regexp_replace(F.regexp_replace(p, "(?<=.)/+$", ""), "/[^/]*$", "")
    return F.when(up == "", "/").otherwise(up)


def properties(lines: Column) -> Column:
    """Map of key=value lines; the last of equal keys wins."""
    pairs = F.filter(F.transform(lines, lambda x: F.split(x, "=", 2)), lambda kv: F.size(kv) == 2)
    keys = F.transform(pairs, lambda kv: F.trim(F.get(kv, F.lit(0))))
    last = F.filter(F.transform(pairs, lambda kv, i: F.struct(F.trim(F.get(kv, F.lit(0))).alias("key"), F.trim(F.get(kv, F.lit(1))).alias("value"), i.alias("i"))), lambda x: ~F.array_contains(F.slice(keys, x["i"] + 2, F.greatest(F.size(keys), F.lit(1))), x["key"]))
    return F.map_from_entries(F.transform(last, lambda x: F.struct(x["key"], x["value"])))


def first_absolute(text: Column) -> Column:
    """First blank-separated token that begins with '/'."""
    return F.get(F.filter(F.split(F.trim(F.coalesce(text, F.lit(""))), r"\s+"), lambda t: t.startswith("/")), F.lit(0))


#: A shell word: parts without blanks, quoted parts and escaped characters.
SHELL_WORD = r"""(?:[^\s"'\\]|"(?:[^"\\]|\\.)*"|'[^']*'|\\.)+"""


def shell_words(text: Column) -> Column:
    """Words of a command line without their quotes; a line with an open quote is split at blanks."""
    words = F.regexp_extract_all(text, F.lit(f"({SHELL_WORD})"), F.lit(1))
    bare = lambda w: F.regexp_replace(F.regexp_replace(w, r"""'([^']*)'|"((?:[^"\\]|\\.)*)\"""", "$1$2"), r"\\(.)", "$1")
    whole = F.regexp_replace(text, rf"{SHELL_WORD}|\s+", "") == ""
    return F.when(whole, F.transform(words, bare)).otherwise(F.filter(F.split(text, r"\s+"), lambda w: w != ""))


def line_paths(line: Column) -> Column:
    """Absolute paths of a property line or of a line that is a path itself."""
    s = F.trim(F.coalesce(line, F.lit("")))
    value = F.regexp_replace(s, "^[A-Za-z]+=", "")
    paths = lambda words: F.filter(words, lambda t: t.startswith("/") & ~t.startswith("//"))
    return (
        F.when(s.startswith("ExecStart="), paths(shell_words(value)))
        .when(_starts(s, "FragmentPath=", "EnvironmentFile=", "DropInPaths="), paths(F.split(F.trim(value), r"\s+")))
        .when(s.startswith("/"), F.slice(F.split(s, r"\s+"), 1, 1))
        .otherwise(F.array().cast("array<string>"))
    )


def host_of_file(name: Column) -> Column:
    """Host from a dump's file name."""
    base = F.regexp_extract(name, "([^/]*)$", 1)
    return F.regexp_replace(F.regexp_replace(base, "^(?:manual_inventory_|inventory_|manual_|out_|report_)", ""), r"\.txt$", "")


def has_hint(*texts: Column) -> Column:
    joined = F.lower(F.concat_ws(" ", *[F.coalesce(t, F.lit("")) for t in texts]))
    return joined.rlike("|".join(SERVICE_HINTS))
