import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from headroom.llm import packing as P


def test_word_tokenizer_is_the_tokenizer():
    tok = Tokenizer.from_file(P.tokenizer_path())
    words = P.WordTokenizer(P.tokenizer_path(), remembered=50)
    rnd = random.Random(1)
    parts = ["The", "don't", "I'LL", "naïve", "ÉTÉ", "ñandú,", "x%%%", "12a3", "日本", " ", "\x1c", "end\x1c", "word.", "It'", "x9", "ABC", "é", "<|endoftext|>", "İs", "ß!!", "Σς", "½", "ʰa", "a_b-c", " ", "..", "#tag", "ĳ", "ǅ", "­", "\x00"]
    for _ in range(800):
        text = "".join(rnd.choice(parts) + rnd.choice(["", " ", "\n", "\t  "]) for _ in range(rnd.randrange(9)))
        assert np.frombuffer(words.of_text(text.encode()), "<u2").tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)


def test_every_letter_of_the_shorter_way():
    tok = Tokenizer.from_file(P.tokenizer_path())
    words = P.WordTokenizer(P.tokenizer_path())
    for c in map(chr, range(0xA1, 0x250)):
        for text in (c, f"{c}an", f"na{c}e", f"A{c}", f"{c}{c}.", f"x{c}9{c}", f"{c},{c}y"):
            assert np.frombuffer(words.of_text(text.encode()), "<u2").tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)


def test_plan_respects_every_constraint():
    rnd = random.Random(3)
    for capacity in (P.Capacity(), P.Capacity(64, 3, 1500)):
        for rule in ("norm", "dot"):
            counts = {k: rnd.randrange(40) for k in range(1, min(capacity.tokens, 38) + 1)}
            runs = P.plan(counts, capacity, rule=rule)
            bins = {}
            for r in runs.itertuples():
                for j in range(r.n):
                    bins.setdefault(r.sequence + j, []).append((r.offset, r.length))
            for own in bins.values():
                at = 0
                for offset, length in sorted(own):
                    assert offset == at
                    at += length
                assert at <= capacity.tokens and len(own) <= capacity.documents and sum(x * x for _, x in own) <= capacity.attention
            placed = runs.groupby("length")["n"].sum().to_dict()
            assert placed == {k: n for k, n in counts.items() if n}


def test_packed_rows(spark):
    rnd = random.Random(9)
    rows = [(i, "word " * rnd.randrange(900), 1) for i in range(120)] + [(None, None, 1), (3, "", 1), (3, "", 1), (500, "long text " * 4000, 1)]
    out = P.packed(spark.createDataFrame(rows, "doc_id long, text string, length int")).collect()
    tok = Tokenizer.from_file(P.tokenizer_path())
    want = []
    for d, t, _ in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        want += [(d, k, at, len(ids[at : at + 2048]), zlib.crc32(np.array(ids[at : at + 2048], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 2048))]
    assert sorted((tuple(r[:5]) for r in out), key=str) == sorted(want, key=str)
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        ends = [0]
        for o, n in sorted(own):
            assert o == ends[-1]
            ends.append(o + n)
        assert ends[-1] <= 2048
    total = sum(w[3] for w in want)
    assert len(bins) <= -(-total // 2048) + 2
    assert P.packed(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_each_capacity_can_bind():
    """Sequences that the same pieces take when one capacity after the other is the tight one."""
    rnd = random.Random(5)
    counts = {k: rnd.randrange(1, 30) for k in range(1, 400)}
    used = lambda c: int((lambda r: (r["sequence"] + r["n"]).max())(P.plan(counts, c)))
    pieces, tokens, attention = sum(counts.values()), sum(k * n for k, n in counts.items()), sum(k * k * n for k, n in counts.items())
    free = used(P.Capacity())
    assert free <= -(-tokens // 2048) + 2
    few, cheap = used(P.Capacity(documents=5)), used(P.Capacity(attention=300_000))
    assert few > free and few >= -(-pieces // 5) and few <= 1.05 * pieces / 5 + 2
    assert cheap > free and cheap >= -(-attention // 300_000) and cheap <= 1.2 * attention / 300_000


def test_plan_against_placing_one_by_one():
    """The plan by classes of equal bins is best-fit decreasing, item after item."""
    rnd = random.Random(7)
    capacity, weights = P.Capacity(100, 6, 4000), (1.0, 0.05, 0.2)
    counts = {k: rnd.randrange(6) for k in range(1, 60)}
    most = np.array([100, 6, 4000], float)
    bins = []
    for length in sorted(counts, reverse=True):
        demand = np.array([length, 1, length**2], float)
        for _ in range(counts[length]):
            fits = [b for b in bins if (b >= demand).all()]
            if fits:
                best = min(fits, key=lambda b: (np.array(weights) * ((b - demand) / most) ** 2).sum())
                best -= demand
            else:
                bins.append(most - demand)
    runs = P.plan(counts, capacity, weights)
    assert abs(int((runs["sequence"] + runs["n"]).max()) - len(bins)) <= 1
