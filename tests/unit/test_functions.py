import math

import pytest
from pyspark.sql import functions as F

from headroom.functions import paths as P
from headroom.functions import scalars as C


def one(spark, column, **values):
    kinds = {str: "string", float: "double", int: "int", type(None): "double"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items()) or "z int"
    row = spark.createDataFrame([tuple(values.values()) or (1,)], schema)
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("x, want", [(-5.0, 0.0), (105.0, 100.0), (None, None), (50.0, 50.0)])
def test_clip_keeps_missing(spark, x, want):
    assert one(spark, C.clip(F.col("x")), x=x) == want


@pytest.mark.parametrize("text, want", [("prod", "prod"), (" Prod ", "prod"), ("production", "non-prod"), ("", "non-prod")])
def test_env_group(spark, text, want):
    assert one(spark, C.env_group(F.col("x")), x=text) == want


@pytest.mark.parametrize("text, want", [("", "empty_as"), ("A/B c", "A_B_c"), ("Кластер", "host"), ("..x..", "x")])
def test_slug(spark, text, want):
    assert one(spark, C.slug(F.col("x")), x=text) == want


def test_lists_and_tags(spark):
    assert one(spark, C.clean_list(F.col("x")), x=" a, ,b ,") == ["a", "b"]
    assert one(spark, C.int_list(F.col("x")), x="30, 90") == [30, 90]
    tags = F.array(*[F.struct(F.lit(k).alias("tag"), F.lit(v).alias("value")) for k, v in (("ENV", " "), ("ENV", " dev "), ("AS", "b"), ("AS", "a"))])
    assert one(spark, C.tag_value(tags, "ENV")) == "dev" and one(spark, C.tag_value(tags, "none")) == ""
    assert one(spark, C.preferred_value(tags, "AS", ("a", "b"))) == "a" and one(spark, C.preferred_value(tags, "AS", ())) == "b"


@pytest.mark.parametrize("w, p, c, want", [(None, None, None, 50.0), (0.0, 0.0, 0.9, 100.0), (1.5, 20.0, 0.4, 0.0)])
def test_confidence(spark, w, p, c, want):
    f = lambda v: F.lit(v).cast("double")
    assert one(spark, C.confidence_index(f(w), f(p), f(c))) == pytest.approx(want)


def test_selection_score_without_backtest(spark):
    none = F.lit(None).cast("double")
    assert one(spark, C.selection_score(none, none, none)) == 21.0


@pytest.mark.parametrize("d, want", [(30, "critical_now"), (31, "critical_soon"), (90, "critical_soon"), (91, "risk_6m"), (365, "risk_12m"), (366, "stable")])
def test_bucket(spark, d, want):
    assert one(spark, C.bucket_90(F.col("x")), x=d) == want


def test_labels_and_texts(spark):
    assert one(spark, C.label("metric", F.lit("cpu"))) == "CPU" and one(spark, C.label("metric", F.lit("gpu"))) == "gpu"
    assert one(spark, C.percent_text(F.lit(12.34))) == "12.3%" and one(spark, C.percent_text(F.lit(None).cast("double"))) == "n/a"
    assert one(spark, C.confidence_level(F.lit(None).cast("double"))) == "medium" and one(spark, C.confidence_level(F.lit(75.0))) == "high"
    assert one(spark, C.iso_utc(F.lit(0))) is None and one(spark, C.iso_utc(F.lit(1700000000))) == "2023-11-14T22:13:20+00:00"


@pytest.mark.parametrize("text, want", [("Disabled", True), ("not monitored", True), ("0", True), ("no", True), ("Monitored", False), ("10", False)])
def test_disabled(spark, text, want):
    assert one(spark, C.status_is_disabled(F.col("x")), x=text) is want


def test_item_paths(spark):
    assert one(spark, P.item_paths(F.lit("vfs.fs.size[/var/log,pused]"), F.lit("https://h/x /proc/1 /etc"))) == ["/h/x", "/var/log,pused"]


@pytest.mark.parametrize("p, item, file, dump", [
    ("/var/log/x.crt", "log_like", "cert_file", "certificate"),
    ("/etc/ssl/site.conf", "config_like", "config_file", "certificate"),
    ("/usr/bin/tool", "binary_like", "binary_file", "binary"),
    ("/var/lib/pg/x", "data_like", "data_file", "data"),
    ("/opt/app/run.log.1", "other", "log_file", "binary"),
    ("/data/.journal", "data_like", "other", "data"),
    ("/srv/x.JOURNAL", "other", "data_file", "log"),
])
def test_path_kinds(spark, p, item, file, dump):
    assert one(spark, F.array(P.item_path_kind(F.col("x")), P.file_kind(F.col("x")), P.dump_kind(F.col("x"))), x=p) == [item, file, dump]


def test_certificate_hint_anywhere(spark):
    assert one(spark, P.certificate_kind(F.lit("/opt/cache"), F.lit("other"))) == "certificate_like"
    assert one(spark, P.certificate_kind(F.lit("/opt/x"), F.lit(None).cast("string"))) == ""


@pytest.mark.parametrize("p, want", [("/a/b", "/a"), ("/a/b/", "/a"), ("/a", "/"), ("/", "/")])
def test_parent(spark, p, want):
    assert one(spark, P.parent(F.col("x")), x=p) == want


def test_unit_properties(spark):
    lines = F.array(*map(F.lit, ("A=1", "B=x=y", "junk", "A=2")))
    assert one(spark, P.properties(lines)) == {"A": "2", "B": "x=y"}
    assert one(spark, P.first_absolute(F.lit("{ path=/x ; /usr/bin/a -b }"))) == "/usr/bin/a"
    assert one(spark, P.line_paths(F.lit(' ExecStart=/usr/sbin/n -c "/etc/n.conf" //no'))) == ["/usr/sbin/n", "/etc/n.conf"]
    assert one(spark, P.line_paths(F.lit("""ExecStart=/bin/a "/opt/my app/x" '/q r' /e\\ f //no "/g\\"h\""""))) == ["/bin/a", "/opt/my app/x", "/q r", "/e f", '/g"h']
    assert one(spark, P.line_paths(F.lit('ExecStart=/bin/a "/open /b'))) == ["/bin/a", "/b"]
    assert one(spark, P.line_paths(F.lit("text /x"))) == []
    assert one(spark, P.host_of_file(F.lit("/d/manual_inventory_h1.txt"))) == "h1"


def test_unquote(spark):
    assert one(spark, C.unquote(F.lit(" \"'eth0'\" "))) == "eth0"


def test_error_measures(spark):
    df = spark.createDataFrame([(10.0, 12.0), (20.0, 16.0), (0.0, 0.0)], "y double, f double")
    r = df.agg(C.wape(F.col("y"), F.col("f")).alias("w"), C.pinball(F.col("y"), F.col("f"), 0.9).alias("p")).first()
    assert r.w == pytest.approx(6 / 30) and r.p == pytest.approx((0.2 + 3.6 + 0) / 3)
    assert df.filter("y = 0").agg(C.wape(F.col("y"), F.col("f") + 2).alias("w")).first().w == 2.0


def test_names_sorted(spark):
    from headroom.operators.inventory import names_sorted

    assert one(spark, names_sorted(F.array(F.lit("b"), F.lit(""), F.lit(None), F.lit("a")))) == ["a", "b"]


@pytest.mark.parametrize("x", [-9.0, -3.0, -0.4, 0.0, 0.3, 0.5, 1.0, 3.9, 4.1, 9.0, 20.0])
def test_erfc(spark, x):
    assert one(spark, C.erfc(F.col("x")), x=x) == pytest.approx(math.erfc(x), rel=1e-12)
