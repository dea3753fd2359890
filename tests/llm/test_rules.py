import random
import re
from collections import Counter

from headroom.llm import rules as R

BLANK = " \t\n\x0b\x0c\r"


def brute(text):
    t = text or ""
    w = [x for x in re.split(f"[{BLANK}]+", t) if x]
    lines = [x for x in t.split("\n") if x.strip(BLANK)]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(5)}
    counts = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))
    return (*counts, len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_counts_match_brute_force(spark):
    rnd = random.Random(1)
    bits = ["a", "b", "é", "a b c d e", "x#", "|", "same line here", "日本", "\x1c"]
    rows = [(i, "".join(rnd.choice(bits) + rnd.choice([" ", "\n", "\t", "  ", " "]) for _ in range(rnd.randrange(40))), 1) for i in range(150)]
    rows += [(None, None, 1), (None, "", 1), (3, "one two three four five " * 400, 1), (3, "one two three four five " * 400, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    out = R.quality_rules(df, labels).collect()
    got = sorted(((r.doc_id, *(r[c] for c in R.COUNTS), r.base_failed) for r in out), key=str)
    assert got == sorted(((d, *brute(t)) for d, t, _ in rows), key=str)
    assert all(r.kept is (not r.base_failed) and r.rule is None for r in out)
    assert R.quality_rules(df.limit(0), labels).count() == 0


def test_learned_list_rejects_what_labels_reject(spark):
    rnd = random.Random(2)
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        words = [("%s%%%%" if bad else "%s") % "".join(rnd.choices("abcdefgh", k=rnd.randrange(2, 9))) for _ in range(40)]
        rows.append((i, " ".join(words)))
        labels.append((i, int(not bad)))
    labels += [(None, 0), (5, None), (9999, 0)]
    df, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    counts = R.cut(R.with_counts(df).drop("text"), "t")
    learned = R.learn_from_labels(counts, lab)
    assert len(learned) == 1 and learned[0][0].feature == "symbols_per_word" and learned[0][0].above
    assert {r.doc_id for r in R.apply_rules(counts, learned).filter("kept").collect()} == {i for i in range(600) if i % 4}


def test_limits_are_told_and_a_failed_start_does_not_end_the_list(spark):
    names = list(R.features())
    # two kinds of bad rows, seen by two features
    rows = []
    for k in range(400):
        grow = k % 2 == 0
        kind = k % 8 // 2
        rows.append((40, 400 if kind == 1 else 200, 60 if kind == 0 else 0, 0, 0, kind < 2, grow))
    df = spark.createDataFrame(rows, "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, bad boolean, grow boolean")
    have = R.with_counts(spark.createDataFrame([(1, "a b c")], "doc_id long, text string"))
    full = df.withColumns({c: R.F.lit(0).cast(have.schema[c].dataType) for c in have.columns if c not in (*df.columns, "doc_id", "text")})
    learned = R.learn(full)
    assert len(learned) == 2 and not learned.cut and {r[0].feature for r in learned} <= set(names)
    assert (len(R.learn(full, most_rules=1)), R.learn(full, most_rules=1).cut) == (1, True)
    # symbols promise most where rules are grown, and fail where they are pruned: the list goes on with another start
    failing = full.withColumn("n_symbols", R.F.when(R.F.col("grow"), R.F.col("bad").cast("long") * 60).otherwise((~R.F.col("bad")).cast("long") * 60)).withColumn("word_chars", R.F.when(R.F.col("bad"), 400).otherwise(200).cast("long"))
    assert [r[0].feature for r in R.learn(failing)] and all(c.feature != "symbols_per_word" for r in R.learn(failing) for c in r)
