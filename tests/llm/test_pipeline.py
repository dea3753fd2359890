import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from headroom.llm import credentials, packing

from .test_mixing import brute_targets
from .test_neardup import brute_groups
from .test_rules import brute as brute_counts


def brute(rows):
    """What the first three stages keep, without labels: (doc_id, source, masked text)."""
    kept = [r for r in rows if not brute_counts(r[1])[-1]]
    least, component = {}, dict(zip((r[0] for r in kept), brute_groups([r[1] for r in kept])))
    for r in kept:
        least.setdefault(component[r[0]], r)
    out = []
    for d, text, _, source, _ in least.values():
        base, weak = credentials.parts_of(text)
        assert not weak
        at, parts = 0, []
        for start, _, _, end in base:
            if start >= at:
                parts += [text[at:start], credentials.MASK]
            at = max(at, end)
        out.append((d, source, "".join(parts) + text[at:]))
    return out


def test_run_matches_brute_force(spark, tmp_path):
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(500)]
    rows = []
    for i in range(120):
        text = " ".join(rnd.choices(words, k=rnd.randrange(5, 200)))
        rows.append((i, text + (' token = "abcdefgh12345678"' if i % 7 == 0 else ""), "en", rnd.choice("abc") if i % 11 else None, 5))
    rows += [(1000 + i, rows[i * 3][1], "en", "a", 5) for i in range(20)] + [(2000, None, None, None, None), (2001, "", "en", "a", 0), (2002, "again and again it says " * 30, "en", "b", 7)]
    d = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    out = corpus_pipeline.run(spark, d).collect()
    kept = brute(rows)
    tok = Tokenizer.from_file(packing.tokenizer_path())
    ids = {k: [*tok.encode(t, add_special_tokens=False).ids, 0] for k, _, t in kept}
    copies = Counter(r.doc_id for r in out if r.piece == 0)
    assert set(copies) <= set(ids) and max(copies.values()) <= 3
    for r in out:
        own = ids[r.doc_id][r.start : r.start + 2048]
        assert r.length == len(own) and r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
    size, source = {k: len(t.split()) for k, _, t in kept}, {k: s for k, s, _ in kept}
    totals, taken = defaultdict(int), defaultdict(int)
    for k in size:
        totals[source[k]] += size[k]
        taken[source[k]] += size[k] * copies.get(k, 0)
    target = brute_targets(dict(totals))
    assert all(abs(taken[s] - target[s]) <= max(size.values()) for s in totals)


def test_nothing(spark, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, d).count() == 0
    assert corpus_pipeline.run(spark, d).count() == 0


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near-dedup", "secret scan", "source mixing", "packing"]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, extra string, copies int"
    df = spark.createDataFrame([], kinds)
    for _, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, df, "").columns == ["doc_id", "text", "lang", "source", "n_chars"] and stage(spark, df, "").count() == 0
