"""Secret scan: strong spans by pattern, weak candidates by linking the parts of a credential.

A lone random-looking token, user name or address says little; together within one scope they are a
credential. A vectorised scan finds all parts of every whole text; Spark then joins the secrets of a
row with the complements (access identifiers and endpoints) that begin within `SCOPE` code points of
them. The interval join is an equi-join on (row, cell of SCOPE code points) followed by the exact
test, so its work is bounded by what one scope can hold. Weak parts that take part in no link are not
reported; for the others the result tells which kinds of secrets and complements co-occurred.

A URL gives parts of its own: the user and the password before its host, and the rest as endpoint. An
endpoint that runs into a base span ends before it. A random-looking run is taken whole.

Defined cases: null text is the empty text, with no spans and the SHA-256 of the empty string;
null doc_ids and repeated rows are kept, one result row each; spans that begin together are told in the
order of KINDS; very long texts and runs are scanned whole; an empty table gives an empty result; other
columns of the input are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import DOCUMENT_COLUMNS, cut, read, with_row_key

#: Base patterns of the contract; letters of the first are matched in either case, ASCII only.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A run shorter than 24 is dropped, and inside a run no later start is longer: asking for 24 is the same.
HEX = re.compile(r"[0-9a-f]{24,}")
LONGEST_DROPPED = {"assign": 6, "access": 20}

#: Weak parts. Names of identifiers, and addresses of services.
IDENT = re.compile(r"""\b(?:access_?key(?:_?id)?|client_?id|account_?(?:id|name)|user_?name|user|login|tenant_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}""", re.ASCII | re.IGNORECASE)
ENDPOINT = re.compile(r"""\b(?:[a-z][a-z0-9+]{1,15}://[A-Za-z0-9._~:/?#@%&=+-]{4,}|(?:host|endpoint|server|bucket)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.:/-]{4,})""", re.ASCII)
OPAQUE = re.compile(r"[A-Za-z0-9+/_=-]{16,}", re.ASCII)
#: Scheme, user information and host of a URL.
AUTHORITY = re.compile(r"([a-z0-9+]+://)(?:([^/?#]*)@)?", re.ASCII)
OPAQUE_BITS = 3.2

KINDS = ("assign", "access", "hex", "ident", "opaque", "endpoint", "user", "password")
SECRETS = ("assign", "hex", "opaque", "password")
COMPLEMENTS = ("access", "ident", "endpoint", "user")
WEAK = ("ident", "opaque", "endpoint", "user", "password")
LEAST_ENDPOINT = 4
#: A complement begins within so many code points of a secret.
SCOPE = 200
MASK = "[SECRET]"

Part = tuple[int, int, str, int]  # start, rank of the kind, kind, end


def is_opaque(token: str) -> bool:
    """Lower case, upper case and digits together, and the entropy of a random token."""
    if not (any(c.isdigit() for c in token) and any(c.islower() for c in token) and any(c.isupper() for c in token)):
        return False
    n = len(token)
    return -sum(k / n * math.log2(k / n) for k in Counter(token).values()) >= OPAQUE_BITS


def parts_of_url(start: int, url: str) -> list[Part]:
    """Endpoint, user and password of an address that begins at `start`."""
    m = AUTHORITY.match(url)
    if not m or m[2] is None:
        return [(start, 5, "endpoint", start + len(url))]
    user, _, password = m[2].partition(":")
    at, host = start + len(m[1]), start + m.end()
    parts = [(at, 6, "user", at + len(user)), (at + len(user) + 1, 7, "password", at + len(m[2])), (host, 5, "endpoint", start + len(url))]
    return [p for p in parts if p[3] > p[0]]


def beside(weak: Part, base: list[Part]) -> Part | None:
    """A weak part outside all base spans; of an endpoint what lies before the first one that it runs into."""
    over = [b for b in base if b[0] < weak[3] and weak[0] < b[3]]
    if not over:
        return weak
    end = min(b[0] for b in over)
    return (*weak[:3], end) if weak[2] == "endpoint" and end - weak[0] >= LEAST_ENDPOINT else None


def parts_of(text: str) -> tuple[list[Part], list[Part]]:
    """Base spans and weak parts of a text. Weak parts don't overlap base spans."""
    base: list[Part] = []
    low = text.lower()
    if any(k in low for k in ("passw", "secret", "token", "api")):
        base += [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LONGEST_DROPPED["assign"]]
    if "AKIA" in text:
        base += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LONGEST_DROPPED["access"]]
    base += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text)]
    base.sort()
    weak: list[Part] = []
    if ":" in text or "=" in text:
        weak += [(m.start(), 3, "ident", m.end()) for m in IDENT.finditer(text)]
        for m in ENDPOINT.finditer(text):
            weak += parts_of_url(m.start(), m[0])
    if base or weak:  # an opaque token without a complement is never reported
        weak += [(m.start(), 4, "opaque", m.end()) for m in OPAQUE.finditer(text) if is_opaque(m[0])]
    if base and weak:
        weak = [w for w in (beside(w, base) for w in weak) if w]
    return base, sorted(weak)


def joined(parts: list[Part]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in parts)


def scan(text: Column) -> Column:
    """Struct of the base spans and the weak parts of a text, each as kind:start:end joined by commas."""

    @F.pandas_udf("base string, weak string")
    def of(texts: pd.Series) -> pd.DataFrame:
        found = [parts_of(t or "") for t in texts]
        return pd.DataFrame({"base": [joined(b) for b, _ in found], "weak": [joined(w) for _, w in found]})

    return of(text)


def _array(spans: Column) -> Column:
    """Array of structs of a joined string, in the order of the contract when sorted."""
    split = F.filter(F.split(spans, ","), lambda x: x != "")

    def of(x: Column) -> Column:
        y = F.split(x, ":")
        return F.struct(F.get(y, 1).cast("long").alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), F.get(y, 0)).alias("rank"), F.get(y, 0).alias("kind"), F.get(y, 2).cast("long").alias("end"))

    return F.transform(split, of)


def _string(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def _has(parts: Column, kinds: tuple[str, ...]) -> Column:
    return parts.rlike(rf"(^|,)({'|'.join(kinds)}):")


def linked_parts(scanned: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(__row, linked, linked_kinds): the weak parts of each row that a link reports, and which kinds met. scanned: __row, base, weak."""
    every = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.when(F.col("weak") != "", F.col("weak")))
    both = scanned.filter(F.col("weak") != "").select("__row", every.alias("parts")).filter(_has(F.col("parts"), SECRETS) & _has(F.col("parts"), COMPLEMENTS))
    parts = both.select("__row", F.explode(_array(F.col("parts"))).alias("p"))
    cell = lambda at: F.floor(at / scope)
    secrets = parts.filter(F.col("p.kind").isin(*SECRETS)).select("__row", F.col("p").alias("s"), F.explode(F.sequence(cell(F.col("p.start") - scope), cell(F.col("p.end") + scope))).alias("cell"))
    others = parts.filter(F.col("p.kind").isin(*COMPLEMENTS)).select("__row", F.col("p").alias("c"), cell(F.col("p.start")).alias("cell"))
    links = secrets.join(others, ["__row", "cell"]).filter((F.col("c.start") >= F.col("s.start") - scope) & (F.col("c.start") <= F.col("s.end") + scope))
    told = links.select("__row", F.concat_ws("+", "s.kind", "c.kind").alias("kinds"), F.explode(F.array("s", "c")).alias("p"))
    weak_parts = F.collect_set(F.when(F.col("p.kind").isin(*WEAK), F.col("p"))).alias("linked")
    return told.groupBy("__row").agg(weak_parts, F.array_join(F.array_sort(F.collect_set("kinds")), ",").alias("linked_kinds"))


def secret_spans(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Counts, digest and spans of every row of docs (doc_id, text); n_linked: the weak parts among the spans."""
    scanned = cut(with_row_key(docs.select("doc_id", "text"), "__row").select("doc_id", "__row", scan(F.col("text")).alias("x")).select("doc_id", "__row", "x.base", "x.weak"), "secrets")
    spans = _array(F.col("base"))
    count = lambda kind: F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    linked = F.coalesce("linked", F.array().cast("array<struct<start:bigint,rank:bigint,kind:string,end:bigint>>"))
    return scanned.join(linked_parts(scanned, scope), "__row", "left").select(
        "doc_id",
        *map(count, KINDS[:3]),
        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
        _string(F.concat(spans, linked)).alias("spans"),
        F.size(linked).cast("long").alias("n_linked"),
        F.coalesce("linked_kinds", F.lit("")).alias("linked_kinds"),
    )


def redact(text: Column, spans: Column) -> Column:
    """The text with each span (kind:start:end, comma-joined) replaced by MASK; overlapping spans become one."""

    @F.pandas_udf("string")
    def of(texts: pd.Series, told: pd.Series) -> pd.Series:
        out = []
        for t, s in zip(texts, told):
            pieces, at = [], 0
            for start, end in sorted(tuple(map(int, x.split(":")[1:])) for x in s.split(",") if x):
                if start >= at:
                    pieces += [t[at:start], MASK]
                at = max(at, end)
            out.append("".join(pieces) + t[at:])
        return pd.Series(out, dtype=object)

    return of(text, spans)


def redact_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """docs with masked secrets; n_chars is the new length where a text has changed. Other rows pass as they are."""
    scanned = cut(with_row_key(docs, "__row").withColumn("__x", scan(F.col("text"))).withColumns({"base": F.col("__x.base"), "weak": F.col("__x.weak")}), "secrets-docs")
    narrow = scanned.select("__row", "base", "weak")
    told = cut(linked_parts(narrow, scope).select("__row", _string(F.col("linked")).alias("linked")), "secrets-linked")
    loud = (F.col("base") != "") | (F.col("weak") != "")
    spans = F.concat_ws(",", "base", "linked")
    changed = scanned.filter(loud).join(told, "__row", "left").withColumn("__spans", F.coalesce(spans, F.lit("")))
    clean = changed.withColumn("__new", redact(F.coalesce("text", F.lit("")), F.col("__spans")))
    same = F.col("__new") == F.coalesce("text", F.lit(""))
    masked = clean.withColumns({"n_chars": F.when(same, F.col("n_chars")).otherwise(F.length("__new").cast(docs.schema["n_chars"].dataType)), "text": F.when(same, F.col("text")).otherwise(F.col("__new"))})
    return scanned.filter(~loud).select(*docs.columns).unionByName(masked.select(*docs.columns))


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(read(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: secrets are masked in the texts; no document is dropped."""
    return redact_secrets(docs.select(*DOCUMENT_COLUMNS))
