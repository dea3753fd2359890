"""Host inventory from items: one scan tags every row of every section, one shuffle removes repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import paths as P
from ..functions.scalars import iso_utc, status_is_disabled, unquote

SECTIONS = ("services", "filesystems", "block_devices", "network_interfaces", "ssl_targets", "paths_found_in_items", "raw_service_related_items")


def flatten_tree(tree: DataFrame) -> DataFrame:
    """(system, role, host_ref) of rows with the map column `tree`."""
    systems = tree.select(F.explode("tree").alias("system", "roles"))
    return systems.select("system", F.explode("roles").alias("role", "hosts")).select("system", "role", F.explode("hosts").alias("host_ref"))


def resolve_hosts(refs: DataFrame, hosts: DataFrame) -> DataFrame:
    """refs with the hostid of the host of that technical name, else visible name, else none."""
    by = lambda c: hosts.groupBy(F.col(c).alias("host_ref")).agg(F.min_by("hostid", F.col("hostid").cast("long")).alias(f"by_{c}"))
    rows = refs.join(by("host"), "host_ref", "left").join(by("name"), "host_ref", "left")
    return rows.select("system", "role", "host_ref", F.coalesce("by_host", "by_name").alias("hostid"), F.when(F.col("by_host").isNotNull(), "host").when(F.col("by_name").isNotNull(), "name").otherwise("host_not_found").alias("matched_by"))


def extract(items: DataFrame) -> DataFrame:
    """(hostid, section, value, detail, item_name, item_key, lastvalue, units, lastclock): all sections in one table."""
    text = lambda c: F.coalesce(c, F.lit(""))
    name, key, last = text("name"), text("key_"), text("lastvalue")
    row = lambda section, value, detail: F.struct(F.lit(section).alias("section"), value.cast("string").alias("value"), detail.cast("string").alias("detail"))
    part = lambda pattern, k: unquote(F.regexp_extract(key, pattern, k))
    none = F.lit(None)
    hinted = P.has_hint(name, key, last)
    unit = key.rlike(P.UNIT)
    field = part(P.UNIT, 2)
    one = F.array_compact(
        F.array(
            F.when(unit, row("services", part(P.UNIT, 1), F.when(field != "", field))),
            F.when(~unit & key.rlike(P.PROCESSES) & hinted, row("services", none, F.lit("process_count"))),
            F.when(key.rlike(P.FILESYSTEM), row("filesystems", part(P.FILESYSTEM, 1), part(P.FILESYSTEM, 2))),
            F.when(key.rlike(P.DEVICE), row("block_devices", part(P.DEVICE, 2), F.regexp_extract(key, P.DEVICE, 1))),
            F.when(key.rlike(P.INTERFACE), row("network_interfaces", part(P.INTERFACE, 1), none)),
            F.when(key.rlike(P.CERTIFICATE), row("ssl_targets", part(P.CERTIFICATE, 1), none)),
            F.when(hinted, row("raw_service_related_items", none, none)),
        )
    )
    found = F.transform(P.item_paths(name, key, last), lambda p: row("paths_found_in_items", p, P.item_path_kind(p)))
    rows = items.select("hostid", "itemid", name.alias("item_name"), key.alias("item_key"), last.alias("lastvalue"), "units", iso_utc(F.col("lastclock")).alias("lastclock"), F.explode(F.concat(one, found)).alias("x")).select("hostid", "itemid", "x.*", "item_name", "item_key", "lastvalue", "units", "lastclock")
    # what makes two rows of a section the same; long values are compared by hash
    whole = F.col("section").isin("raw_service_related_items") | ((F.col("section") == "services") & F.col("value").isNull())
    same = F.xxhash64(F.when(whole, F.col("item_name")), "value", "detail", "item_key", F.when(F.col("section") != "paths_found_in_items", F.xxhash64("lastvalue")))
    keep = ["value", "detail", "item_name", "item_key", "lastvalue", "units", "lastclock"]
    first = F.min_by(F.struct(*keep), F.col("itemid").cast("long")).alias("r")
    return rows.groupBy("hostid", "section", same.alias("same")).agg(first).select("hostid", "section", "r.*")


def section(extracted: DataFrame, name: str) -> DataFrame:
    return extracted.filter(F.col("section") == name)


def host_summary(resolved: DataFrame, items: DataFrame, extracted: DataFrame) -> DataFrame:
    """Items and rows by section of every host reference; hosts that weren't found have no section counts."""
    counted = items.groupBy("hostid").agg(F.count(F.lit(1)).alias("items"))
    per = extracted.groupBy("hostid").agg(*[F.count_if(F.col("section") == s).alias(s) for s in SECTIONS])
    rows = resolved.join(counted, "hostid", "left").join(per, "hostid", "left")
    missing = F.col("hostid").isNull()
    count = lambda s: F.when(~missing, F.coalesce(s, F.lit(0)))
    names = F.array_compact(F.array(*[F.when(F.coalesce(s, F.lit(0)) > 0, F.lit(s)) for s in SECTIONS]))
    return rows.select("system", "role", "host_ref", "hostid", "matched_by", F.coalesce("items", F.lit(0)).alias("item_count"), F.array_join(names, ", ").alias("matched_sections"), *[count(s).alias(s) for s in SECTIONS])


def names_sorted(values):
    """Non-empty names of an array of strings, sorted."""
    return F.array_sort(F.filter(values, lambda v: F.coalesce(v, F.lit("")) != ""))


def host_labels(hosts: DataFrame) -> DataFrame:
    """(hostid, templates, groups, tags) of hosts: names of templates (else their technical names), of groups, and tag=value texts, sorted."""
    own = lambda t: F.when(F.coalesce(t["name"], F.lit("")) != "", t["name"]).otherwise(t["host"])
    tags = F.array_sort(F.transform(F.filter("tags", lambda t: F.coalesce(t["tag"], F.lit("")) != ""), lambda t: F.struct(t["tag"].alias("tag"), F.coalesce(t["value"], F.lit("")).alias("value"))))
    return hosts.select("hostid", names_sorted(F.transform("templates", own)).alias("templates"), names_sorted(F.transform("groups", lambda g: g["name"])).alias("groups"), F.transform(tags, lambda t: F.concat_ws("=", t["tag"], t["value"])).alias("tags"))


def found_paths(extracted: DataFrame, excerpt: int = 300) -> DataFrame:
    """(hostid, path, kind, item_key, excerpt) of the paths section."""
    return section(extracted, "paths_found_in_items").select("hostid", F.col("value").alias("path"), F.col("detail").alias("kind"), "item_key", F.substring("lastvalue", 1, excerpt).alias("excerpt"))


#: What the rows of a section are ordered by within a host.
SECTION_ORDER = {s: ("value", "item_key") if s in ("services", "network_interfaces", "ssl_targets", "paths_found_in_items") else ("item_name", "item_key") if s == "raw_service_related_items" else ("value", "detail") for s in SECTIONS}


def in_order(extracted: DataFrame) -> DataFrame:
    """extracted with `seq`, the place of a row in its section of its host, from 1."""
    keys = F.create_map(*[F.lit(x) for s, (a, b) in SECTION_ORDER.items() for x in (s, f"{a},{b}")])
    by = lambda k: F.when(F.element_at(keys, F.col("section")) == "item_name,item_key", F.col(("item_name", "item_key")[k])).when(F.element_at(keys, F.col("section")) == "value,item_key", F.col(("value", "item_key")[k])).otherwise(F.col(("value", "detail")[k]))
    order = Window.partitionBy("hostid", "section").orderBy(F.coalesce(by(0), F.lit("None")), F.coalesce(by(1), F.lit("None")), "item_key", "item_name", "lastvalue", F.coalesce("value", F.lit("")), F.coalesce("detail", F.lit("")))
    return extracted.withColumn("seq", F.row_number().over(order))


def host_status(*tables: DataFrame) -> DataFrame:
    """(nhost, status) from all tables that have a host and a status column; the last table and row wins.

    A table may have a column `seq` for the order of its rows.
    """
    out = None
    for k, t in enumerate(tables):
        low = {c.strip().lower(): c for c in t.columns}
        host = next((low[c] for c in ("host", "host ref", "hostname") if c in low), None)
        status = next((low[c] for c in low if "status" in c), None)
        if host is None or status is None:
            continue
        order = F.col(low["seq"]) if "seq" in low else F.lit(0)
        rows = t.filter(F.col(f"`{host}`").isNotNull()).select(F.lower(F.trim(F.col(f"`{host}`"))).alias("nhost"), F.col(f"`{status}`").cast("string").alias("status"), F.lit(k).alias("k"), order.cast("long").alias("seq"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no table has both a host and a status column")
    return out.groupBy("nhost").agg(F.max_by("status", F.struct("k", "seq", "status")).alias("status"))


def enabled_services(services: DataFrame, status: DataFrame) -> DataFrame:
    """services (host, unit, ...) without those of disabled hosts."""
    disabled = status.filter(status_is_disabled(F.col("status"))).select("nhost")
    return services.withColumn("nhost", F.lower(F.trim("host"))).join(disabled, "nhost", "left_anti").drop("nhost")


def unit_lists(services: DataFrame, status: DataFrame) -> DataFrame:
    """(host, seq, unit): the distinct units of every enabled host in order."""
    rows = enabled_services(services, status).filter(F.coalesce(F.trim("unit"), F.lit("")) != "").select("host", F.trim("unit").alias("unit")).distinct()
    return rows.select("host", F.row_number().over(Window.partitionBy("host").orderBy("unit")).alias("seq"), "unit")
