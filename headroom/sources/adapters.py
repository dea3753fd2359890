"""Domain tables derived from the star-schema test tables, so that every job runs on given data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.hosts import host_scope, hosts_by_tag
from ..operators.selection import selection
from ..schemas import Params
from .tables import trend_points


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def hosts(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "supplier").selectExpr(
        "cast(s_suppkey as string) hostid",
        "concat(replace(lower(s_name), '#', '-'), case s_suppkey % 3 when 0 then '.ops.example.com' when 1 then '.example.org' else '' end) host",
        "s_name name",
        "case when s_suppkey % 11 = 5 then '1' else '0' end status",
        """concat(case when s_suppkey % 5 = 0 then cast(array() as array<struct<tag: string, value: string>>)
                       when s_suppkey % 7 = 0 then array(struct('AS' tag, 'AS-9' value), struct('AS' tag, concat('AS-', s_nationkey % 4) value))
                       else array(struct('AS' tag, concat('AS-', s_nationkey % 4) value)) end,
                  array(struct('ENV' tag, ' ' value), struct('ENV' tag, case s_suppkey % 4 when 0 then 'prod' when 1 then ' Prod ' else 'dev' end value))) tags""",
        "array(struct('t-web' host, 'Web' name), struct('t-base' host, '' name), struct('' host, cast(null as string) name)) templates",
        "array(struct(concat('site ', s_nationkey) name), struct('' name), struct('all' name)) groups",
    )


#: Item key of each position, by hostid % 5 where it differs.
KEYS = (
    ("system.cpu.util", "system.cpu.util[all,idle,avg5]", "system.cpu.util[,idle,avg1]", "system.cpu.util[]", "system.cpu.util[,user]"),
    ("vm.memory.size[pavailable]", "vm.memory.size[pavailable]", "vm.memory.size[pavailable,x]", "vm.memory.size[pavailable]", "vm.memory.size[pused]"),
    ("vm.memory.size[total]",),
    ("vm.memory.size[available]", "vm.memory.size[available]", "vm.memory.size[free]", "vm.memory.size[available]", "vm.memory.size[free]"),
    ("vfs.fs.size[/,pused]", "vfs.fs.size[/,pused]", "vfs.fs.size[/,pused]", "vfs.fs.size[C:,pused]", "vfs.fs.size[/data,pused]"),
    ("vfs.fs.size[/,used]", "vfs.fs.size[/,used]", "vfs.fs.size[/,used]", "vfs.fs.size[C:,used]", "vfs.fs.size[/data,used]"),
    ("vfs.fs.size[/,total]",),
    ("system.cpu.util[,idle]", "agent.ping", "agent.ping", "agent.ping", "agent.ping"),
    ("vm.memory.size[used]",),
    ("vfs.fs.size[/data,free]",),
    ("vfs.fs.size[/boot,used]",),
    ("vfs.dev.read[sda]",),
    ("vfs.dev.write[sda]",),
    ("net.if.in[eth0]",),
    ('net.if.out["eth0",bytes]',),
    ("web.certificate.get[site.example.com]",),
    ('systemd.unit.info["nginx.service",ActiveState]',),
    ("systemd.unit.get[postgresql.service]",),
    ("proc.num[postgres]",),
    ("proc.num[bash]",),
    ("proc.num[bash]",),
)


def _sql_array(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def items(spark: SparkSession, d: str) -> DataFrame:
    rotated = [[k[r % len(k)] for k in KEYS] for r in range(5)]
    cases = " ".join(f"when {r} then array({_sql_array(k)})" for r, k in enumerate(rotated))
    rows = read(spark, d, "supplier").selectExpr("s_suppkey", f"posexplode(case s_suppkey % 5 {cases} end) as (i, key_)").withColumn("pos", F.col("i") + 1)
    return rows.selectExpr(
        "cast(s_suppkey * 100 + pos as string) itemid",
        "cast(s_suppkey as string) hostid",
        "case when pos = 1 then 'CPU utilization' else concat('Item ', pos) end name",
        "key_",
        "0 value_type",
        "case when pos = 3 and s_suppkey % 6 = 1 then '1' else '0' end status",
        "case when pos % 2 = 0 then '%' else '' end units",
        "'0' type",
        "'' params",
        "'1h' delay",
        "case pos % 4 when 0 then concat('/var/lib/app', s_suppkey, '/data.log,x /etc/app/app.conf') when 1 then '12.5' when 2 then 'postgres https://h.example/x/y /opt/cache/f.pem /proc/1/x /usr/bin/tool' else null end lastvalue",
        "case when pos % 5 = 0 then 0 else 1700000000 + s_suppkey * 60 + pos end lastclock",
    )


#: Accounts by domain suffix of the hosts above.
ACCOUNTS = {"example.com": "first", "ops.example.com": "second", "example.org": "third"}


def captures(spark: SparkSession, d: str) -> DataFrame:
    """Outputs of a scan of every host: some failed, unreadable, empty or without a unit."""
    return read(spark, d, "supplier").selectExpr(
        "cast(null as string) host",
        "concat('report_host', s_suppkey, '.txt') file",
        "case when s_suppkey % 11 = 3 then 255 else 0 end exit_code",
        "case s_suppkey % 5 when 0 then null when 1 then ' ' when 2 then concat('line ', s_suppkey) else '--- a.service ---\n/opt/x' end text",
    )


def trend_raw(spark: SparkSession, d: str) -> DataFrame:
    """Raw records as text, with bad and missing values among them."""
    return read(spark, d, "lineitem").selectExpr(
        "cast(l_suppkey * 100 + l_linenumber as string) itemid",
        "unix_timestamp(cast(l_shipdate as timestamp)) clock",
        "case when l_linenumber = 3 then null else cast(l_linenumber as string) end num",
        "case when l_quantity = 7 then 'bad' else cast(l_quantity as string) end value_min",
        "case when l_quantity = 13 then null when l_quantity = 14 then 'NaN' else cast(l_quantity * (1 + l_tax) as string) end value_avg",
        "cast(l_quantity * 2 as string) value_max",
    )


def trend(spark: SparkSession, d: str) -> DataFrame:
    return trend_points(trend_raw(spark, d))


def scope(spark: SparkSession, d: str, p: Params = Params()) -> DataFrame:
    return host_scope(hosts_by_tag(hosts(spark, d), p), p)


def selected(spark: SparkSession, d: str, p: Params = Params()) -> DataFrame:
    return selection(items(spark, d), scope(spark, d, p), p)


def util_history(spark: SparkSession, d: str) -> DataFrame:
    """Every event as a point: clicks of CPUs, views of memory, all others of disks."""
    return read(spark, d, "events").selectExpr(
        "case event_type when 'click' then 'cpu' when 'view' then 'ram' else 'disk' end metric",
        "date_trunc('hour', cast(ts as timestamp)) clock",
        "cast(user_id as string) hostid",
        "concat('host-', user_id) host",
        "concat('AS-', user_id % 3) as_value",
        "case when user_id % 4 = 0 then 'PROD' else 'dev' end env_value",
        "case when user_id % 4 = 0 then 'prod' else 'non-prod' end env_group",
        "concat('i', user_id) itemid",
        "least(value, 100D) utilization_pct",
    )


def util_trend(spark: SparkSession, d: str) -> DataFrame:
    keys = ["metric", "clock", "hostid", "host", "as_value", "env_value", "env_group", "itemid"]
    v = "utilization_pct"
    return util_history(spark, d).groupBy(*keys).agg(F.count(v).cast("int").alias("num"), F.min(v).alias("util_min"), F.avg(v).alias("util_avg"), F.max(v).alias("util_max"))


def load(spark: SparkSession, d: str) -> DataFrame:
    """Line quantities as utilization points, a host for each supplier."""
    return read(spark, d, "lineitem").selectExpr(
        "'cpu' metric",
        "cast(l_suppkey as string) hostid",
        "concat('host-', l_suppkey) host",
        "concat('AS-', l_suppkey % 2) as_value",
        "case when l_suppkey % 4 = 0 then 'prod' else 'dev' end env_value",
        "case when l_suppkey % 4 = 0 then 'prod' else 'non-prod' end env_group",
        "cast(l_shipdate as timestamp) clock",
        "l_quantity * (1 + l_suppkey % 3 / 2D) utilization_pct",
    )


def inventory_refs(spark: SparkSession, d: str) -> DataFrame:
    """Host tree: nation to role to host names, some visible names, and one unknown host a nation."""
    rows = hosts(spark, d).join(read(spark, d, "supplier").selectExpr("cast(s_suppkey as string) hostid", "s_nationkey", "s_suppkey"), "hostid").join(read(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    named = rows.selectExpr("n_name system", "concat('role-', s_suppkey % 3) role", "case when s_suppkey % 4 = 3 then name else host end host_ref")
    unknown = rows.selectExpr("n_name system", "'role-x' role", "concat('gone-', lower(n_name)) host_ref").distinct()
    return named.unionByName(unknown)


def tree(spark: SparkSession, d: str) -> DataFrame:
    roles = inventory_refs(spark, d).groupBy("system", "role").agg(F.collect_list("host_ref").alias("hosts"))
    return roles.groupBy("system").agg(F.map_from_entries(F.collect_list(F.struct("role", "hosts"))).alias("roles")).select(F.create_map("system", "roles").alias("tree"))


def dumps(spark: SparkSession, d: str) -> DataFrame:
    """One command dump a host, as lines."""
    lines = [
        "concat('==== app', s_suppkey, '.ops.example.com ====')",
        "'/before/any/unit'",
        "'--- nginx.service ---'",
        "'ExecStart=/usr/sbin/nginx -c \"/etc/nginx/my site.conf\"'",
        "'FragmentPath=/usr/lib/systemd/system/nginx.service'",
        "'EnvironmentFile=/etc/sysconfig/nginx //no'",
        "'   Active: inactive'",
        "'● app.service - web'",
        "'   Active: active (running)'",
        "concat(' Main PID: ', s_suppkey, ' (app)')",
        "concat('/var/log/app', s_suppkey, '/access.log')",
        "'/etc/ssl/certs/site.crt'",
        "'/opt/cache/x y'",
        "'Active: failed'",
    ]
    rows = read(spark, d, "supplier").selectExpr("concat('manual_inventory_host', s_suppkey, '.txt') file", "s_suppkey", f"posexplode(array({', '.join(lines)})) as (line_no, line)")
    return rows.filter("not (line_no = 0 and s_suppkey % 2 = 1)").select("file", "line_no", "line")
