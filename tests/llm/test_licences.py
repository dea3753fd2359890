import random
import re

from headroom.llm import licences as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    starts, labels = [], set()
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        own = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        starts += own
        labels |= {label} if own else set()
    return (len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))


def test_base_matches_brute_force_and_templates_are_found(spark):
    rnd = random.Random(1)
    bits = ["MIT License", "mit-license", "Apache", "license", "General public", "License", "école", "x", "mit", "ÉLICENSE", "İ", "\n", "general public license"]
    rows = [(i, " ".join(rnd.choice(bits) for _ in range(rnd.randrange(15))), "q") for i in range(200)]
    notice = L.TEMPLATES["mit-text"].split()
    broken = " ".join(notice[:20] + ["indeed"] + notice[20:])
    rows += [(None, None, "q"), (None, "", "q"), (900, "filler " * 50 + broken + " tail" * 9, "q"), (901, "word one. Licensed under CC BY-NC 4.0.\nmore", "q"), (901, "word one. Licensed under CC BY-NC 4.0.\nmore", "q"), (902, " ".join(notice[:9]), "q")]
    out = L.license_scan(spark.createDataFrame(rows, "doc_id long, text string, label string")).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out), key=str)
    assert got == sorted(((d, *brute(t)) for d, t, _ in rows), key=str)
    of = {r.doc_id: r for r in out}
    assert of[900].labels == "mit-text" and of[900].score > 0.9 and of[901].labels == "cc-by-nc-4.0-notice"
    assert of[901].spans == "cc-by-nc-4.0-notice:2:9"
    assert of[902].labels == "" and all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in out)
    assert L.license_scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def followed(hits):
    """Spans of one text and template by loops: (share, first, end), from (t_at, at) hits and the template's k-grams."""
    hits, t_n = hits
    runs = []
    for d in sorted({a - t for t, a in hits}):
        ts = sorted(t for t, a in hits if a - t == d)
        for k, t in enumerate(ts):
            if k and t == ts[k - 1] + 1:
                runs[-1][2] = t
            else:
                runs.append([d, t, t])
    chains = []
    for r in runs:
        if chains and r[0] - chains[-1][-1][0] <= L.NEIGHBOURS:
            chains[-1].append(r)
        else:
            chains.append([r])
    out = []
    for chain in chains:
        parts = {}
        for r in chain:
            parts.setdefault((r[0] - chain[0][0]) // t_n, []).append(r)
        for own in parts.values():
            most = max(b - a + 1 for _, a, b in own)
            own = sorted((r for r in own if L.STRAY * (r[2] - r[1] + 1) >= most), key=lambda r: (r[0] + r[1], r[1]))
            done, gain, ends = -1, 0, []
            for d, a, b in own:
                g = max(0, b + 1 - max(a, done + 1))
                done, gain = max(done, b), gain + g
                ends += [d + a, d + b] if g else []
            out.append((round(gain / t_n, 9), min(ends), max(ends) + L.K))
    return sorted(out)


def test_spans_are_followed_in_order(spark):
    rnd = random.Random(5)
    rows, want = [], []
    for i in range(60):
        t_n = rnd.choice([4, 20])
        hits = {(t, t + 40 + rnd.choice([0, 0, 0, 1, 3, 30])) for t in range(t_n) if rnd.random() < 0.8} | {(rnd.randrange(t_n), rnd.randrange(90)) for _ in range(rnd.randrange(6))}
        rows += [(i, "x", t_n, t, a) for t, a in hits]
        want += [(i, *s) for s in followed((hits, t_n))]
    got = L.verified_spans(spark.createDataFrame(rows, "__row long, label string, t_n int, t_at int, at int")).collect()
    assert sorted((r[0], round(r.share, 9), r["first"], r["end"]) for r in got) == sorted(want)


def test_words_of_a_template_in_another_order_are_no_license(spark):
    words = L.TEMPLATES["mit-text"].split()
    blocks = [words[k : k + 6] for k in range(0, len(words), 6)]
    turned = " ".join(w for b in reversed(blocks) for w in b)
    whole = " ".join(words)
    out = {r.doc_id: r for r in L.license_scan(spark.createDataFrame([(1, turned), (2, whole), (3, "start " * 20_000 + whole)], "doc_id long, text string")).collect()}
    assert "mit-text" not in out[1].labels and out[2].labels == "mit-text" and out[2].score == 1.0 and out[3].spans == f"mit-text:20000:{20000 + len(words) + 1}"
