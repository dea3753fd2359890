"""Choice of one CPU, one RAM and one disk item a host, and of feature items, by scores of their keys.

Ties go to the lowest numeric item id. The best of a group is an aggregate (max_by), so no sort and
one shuffle by host; items whose keys can't be chosen are dropped before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clean_list
from ..schemas import SELECTED, Params

# Patterns of item keys, and the names of features by role and mode.
CPU = r"^system\.cpu\.util(?:\[(.*)\])?$"
FILESYSTEM = r"^vfs\.fs\.size\[(.*),(pused|used|free|total)\]$"
RAM_FEATURES = {"pavailable": "pavailable_pct", "pused": "pused_pct", "available": "available_bytes", "used": "used_bytes", "total": "total_bytes"}
DISK_FEATURES = {"pused": "pused_pct", "used": "used_bytes", "free": "free_bytes", "total": "total_bytes"}


def cpu_score(key: Column, name: Column) -> tuple[Column, Column]:
    """(score, transform); a score below 0 rejects."""
    args = F.transform(clean_list(F.regexp_extract(key, CPU, 1)), lambda a: F.lower(a))
    has = lambda x: F.array_contains(args, x)
    idle = 220 + F.when(has("all"), 15).otherwise(0) + F.when(has("avg5"), 15).when(has("avg1"), 10).when(has("avg15"), 5).otherwise(0)
    bonus = F.when(F.lower(F.coalesce(name, F.lit(""))).contains("cpu utilization"), 10).otherwise(0)
    score = F.when(~key.rlike(CPU), -1).when(F.size(args) == 0, 170 + bonus).when(has("idle"), idle + bonus).otherwise(-1)
    return score, F.when(F.size(args) == 0, "identity").otherwise("invert_100")


def ram_role(key: Column) -> tuple[Column, Column]:
    """(role, score) of a memory item."""
    k = lambda x: f"vm.memory.size[{x}]"
    role = (
        F.when(key == k("total"), "total")
        .when((key == k("available")) | (key == k("free")), "available")
        .when(key == k("used"), "used")
        .when(key.startswith("vm.memory.size[pavailable"), "pavailable")
        .when(key.startswith("vm.memory.size[pused"), "pused")
    )
    score = (
        F.when(key == k("free"), 210)
        .when(key == k("pavailable"), 250)
        .when(key.startswith("vm.memory.size[pavailable"), 240)
        .when(key == k("pused"), 180)
        .when(key.startswith("vm.memory.size[pused"), 170)
        .otherwise(220)
    )
    return role, score


def fs_score(fs: Column, preferred: tuple[str, ...]) -> Column:
    place = F.array_position(F.array(*map(F.lit, preferred)), fs) if preferred else F.lit(0)
    return F.when(place > 0, 1000 - (place - 1)).when(fs == "/", 700).when(F.upper(fs).startswith("C"), 650).otherwise(500).cast("int")


def _best(items: DataFrame, keys: list[str], score: str) -> DataFrame:
    """One row for each of keys: the highest score, then the lowest item id."""
    rest = [c for c in items.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(F.col(score), -F.col("itemid").cast("long"))).alias("__best")
    return items.groupBy(*keys).agg(best).select(*keys, *[f"__best.{c}" for c in rest])


def select_cpu(items: DataFrame) -> DataFrame:
    score, transform = cpu_score(F.col("key_"), F.col("name"))
    scored = items.filter(F.col("key_").startswith("system.cpu.util")).withColumns({"score": score, "transform": transform}).filter("score >= 0")
    return _best(scored.select("hostid", "itemid", "key_", "value_type", "score", "transform"), ["hostid"], "score")


def select_ram(items: DataFrame) -> DataFrame:
    """Best item of each memory role of a host."""
    role, score = ram_role(F.col("key_"))
    scored = items.filter(F.col("key_").startswith("vm.memory.size[")).withColumns({"role": role, "score": score}).filter("role is not null")
    return _best(scored.select("hostid", "role", "itemid", "key_", "value_type", "score"), ["hostid", "role"], "score")


def select_disk(items: DataFrame, p: Params = Params()) -> DataFrame:
    """Items by mode of the best file system of a host; file systems without `pused` don't compete."""
    fs, mode = (F.regexp_extract("key_", FILESYSTEM, k) for k in (1, 2))
    modes = items.filter(F.col("key_").rlike(FILESYSTEM)).select("hostid", fs.alias("entity"), mode.alias("mode"), "itemid", "key_", "value_type")
    one = modes.groupBy("hostid", "entity", "mode").agg(F.min_by(F.struct("itemid", "key_", "value_type"), F.col("itemid").cast("long")).alias("item"))
    per = one.groupBy("hostid", "entity").agg(F.collect_list(F.struct("mode", "item")).alias("modes"), F.min(F.col("item.itemid").cast("long")).alias("first"))
    able = per.filter(F.exists("modes", lambda m: m["mode"] == "pused")).withColumn("score", fs_score(F.col("entity"), p.disk_fs))
    best = able.groupBy("hostid").agg(F.max_by(F.struct("entity", "modes", "score"), F.struct(F.col("score"), -F.col("first"))).alias("b"))
    return best.select("hostid", "b.entity", "b.score", F.explode("b.modes").alias("m")).select("hostid", "entity", "score", "m.mode", "m.item.*")


def _disk_rows(disks: Column, p: Params) -> Column:
    """The items by mode of the best file system among a host's (entity, mode, id, item) structs; none without `pused`."""
    of = lambda e: F.filter(disks, lambda d: d["entity"] == e)
    first = lambda found: F.array_min(F.transform(found, lambda d: d["id"]))
    able = F.transform(F.filter(disks, lambda d: d["mode"] == "pused"), lambda d: F.struct(fs_score(d["entity"], p.disk_fs).alias("score"), (-first(of(d["entity"]))).alias("id"), d["entity"].alias("entity")))
    best = F.array_max(able)["entity"]
    one = lambda mode: F.array_min(F.transform(F.filter(of(best), lambda d: d["mode"] == mode), lambda d: F.struct(d["id"].alias("id"), d["mode"].alias("mode"), d["entity"].alias("entity"), d["item"].alias("item"))))
    return F.array_compact(F.array(*[one(m) for m in DISK_FEATURES]))


def selection(items: DataFrame, scope: DataFrame, p: Params = Params()) -> DataFrame:
    """The selection report: targets and features of the hosts in scope, schema SELECTED. One scan and one aggregation by host."""
    key = F.col("key_")
    known = items.filter("status = '0'").filter(key.startswith("system.cpu.util") | key.startswith("vm.memory.size[") | key.startswith("vfs.fs.size["))
    cpu, transform = cpu_score(key, F.col("name"))
    role, ram = ram_role(key)
    id_ = F.col("itemid").cast("long")
    item = F.struct("itemid", "key_", "value_type")
    marked = known.select("hostid", id_.alias("id"), item.alias("item"), F.when(cpu >= 0, cpu).alias("cpu"), transform.alias("transform"), role.alias("role"), ram.alias("ram"), F.regexp_extract("key_", FILESYSTEM, 1).alias("entity"), F.regexp_extract("key_", FILESYSTEM, 2).alias("mode"))
    chosen = marked.groupBy("hostid").agg(
        F.max_by(F.struct("item", "transform"), F.when(F.col("cpu").isNotNull(), F.struct("cpu", -F.col("id")))).alias("cpu"),
        *[F.max_by("item", F.when(F.col("role") == r, F.struct("ram", -F.col("id")))).alias(f"ram_{r}") for r in RAM_FEATURES],
        F.collect_list(F.when(F.col("mode") != "", F.struct("entity", "mode", "id", "item"))).alias("disks"),
    )
    placed = chosen.withColumn("disks", _disk_rows(F.col("disks"), p))
    row = lambda item, metric, source, feature, entity, transform: F.struct(F.lit(metric).alias("metric"), F.lit(source).alias("source"), feature.alias("feature"), entity.alias("entity"), item["itemid"].alias("itemid"), item["key_"].alias("key_"), item["value_type"].alias("value_type"), transform.alias("transform"))
    none, same = F.lit(""), F.lit("identity")
    named = F.create_map(*[F.lit(x) for kv in DISK_FEATURES.items() for x in kv])
    rows = F.concat(
        F.array(
            row(F.col("cpu.item"), "cpu", "target", none, none, F.col("cpu.transform")),
            row(F.col("ram_pavailable"), "ram", "target", none, none, F.lit("invert_100")),
            *[row(F.col(f"ram_{r}"), "ram", "feature", F.lit(f), none, same) for r, f in RAM_FEATURES.items()],
        ),
        F.transform(F.filter("disks", lambda d: d["mode"] == "pused"), lambda d: row(d["item"], "disk", "target", none, d["entity"], same)),
        F.transform("disks", lambda d: row(d["item"], "disk", "feature", F.element_at(named, d["mode"]), d["entity"], same)),
    )
    told = placed.select("hostid", F.explode(F.filter(rows, lambda r: r["itemid"].isNotNull())).alias("r")).select("hostid", "r.*")
    return told.join(scope, "hostid").select(*SELECTED)


def selected_counts(selected: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row (for each group): targets and features by metric."""
    n = lambda metric, source: F.count_if((F.col("metric") == metric) & (F.col("source") == source))
    return selected.groupBy(*by).agg(
        n("cpu", "target").alias("cpu_target"),
        n("ram", "target").alias("ram_target"),
        n("disk", "target").alias("disk_target"),
        n("ram", "feature").alias("ram_features"),
        n("disk", "feature").alias("disk_features"),
        F.count_if(F.col("source") == "feature").alias("feature_total"),
    )
