"""Filter audit, sharding and phrase mining against plain Python."""

import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from offerlake.llm import filter_audit, phrases, sharding

DOCS = "doc_id long, text string, lang string, size string, row string, part string"
CLASH = ("s", "r", "p")                                    # columns with names the operators use


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, g, *CLASH) for i, t, g in rows], DOCS).repartition(parts)


def audit_rows():
    rng = random.Random(1)
    vocabulary = ["word%d" % k for k in range(400)]
    rows = [(None, None, None), (None, None, None), (0, "", "en"), (1, "", "en"), (7, None, "fr"), (7, "", "fr"), (7, "", "fr"), (5, "Aa $", ""), (5, "Aa $", None)]
    for i in range(10, 60):
        text = " ".join(rng.choices(vocabulary[:rng.choice((60, 400))], k=rng.choice((50, 199, 200, 260))))
        text += rng.choice(("", "", " #", " ABCDEFGHIJ" * 9))
        rows.append((i, text, rng.choice(("en", "fr", None))))
        if rng.random() < .3:
            rows.append((rng.randrange(70), text, rng.choice(("en", "fr"))))
    rows += [(i, "copy of one", "en") for i in range(100, 180)] + [(None, "copy of one", "en")]
    return rows


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    fails = []
    for i, t, g in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
             "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and least[t] < i}
        fails.append((g or "", {x for x in f if f[x]}, i in good, i in toxic))
    out = {}
    shapley = Counter()
    for part in {g for g, *_ in fails}:
        mine = [x for x in fails if x[0] == part]
        for order in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                gone = [x for x in left if f in x[1]]
                stay = [x for x in left if f not in x[1]]
                shapley[part, f] += len(gone)
                out[part, "".join(order), k + 1] = [len(stay), len(gone), sum(f in x[1] for x in mine) - len(gone), sum(x[1] == {f} for x in mine),
                                                    sum(x[2] for x in gone), sum(x[3] for x in gone)]
                left = stay
    return {(p, o, k): (*v, shapley[p, o[k - 1]]) for (p, o, k), v in out.items()}


def test_audit(spark):
    rows = audit_rows()
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 180)] + [(None, 1, 1), (10, 1, 1), (11, None, None)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(frame(spark, rows), marks).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == plain_audit(rows, labels) and len(got) == 600 * 3
    assert filter_audit.audit(frame(spark, rows).limit(0), marks).count() == 0


def test_audit_needs_the_text_not_only_its_hash(spark):
    texts = spark.createDataFrame([("en", 1, "a", 5, 5), ("en", 2, "b", 5, 5), ("en", 3, "a", 5, 5)], "part string, doc_id long, text string, h long, h2 long")
    assert [r.doc_id for r in filter_audit.repeated(texts).collect()] == [3]


def test_sharding(spark):
    rng = random.Random(2)
    rows = [(rng.choice((None, 3, k)), rng.choice((None, "", "é" * rng.randrange(9), "same")), "en") for k in range(1003)]
    docs = frame(spark, rows, 7)
    got = sharding.assign(docs, shards=40).collect()
    def key(i, t):
        raw = (t or "").encode()
        return (i is None, i or 0, len(raw) + 16, zlib.crc32(raw))
    assert Counter(key(i, t) for i, t, _ in rows) == Counter((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in got)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(slots) == list(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {len(s) for s in slots.values()} == {25, 26}
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    assert got == sharding.assign(docs, shards=40).collect()
    few = sharding.shuffle(docs.limit(3), shards=5).collect()
    assert sorted((r.shard, r.slot) for r in few) == [(0, 0), (1, 0), (2, 0)] and few[0].row.part == "p"
    assert sharding.assign(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        sharding.shuffle(docs, shards=0)


def test_sharding_numbers_buckets_without_gaps(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 10)
    monkeypatch.setattr(sharding, "PARTS_PER_GROUP", 2)          # several groups draw their rows
    docs = spark.range(0, 2000, 1, 7)
    sharding.write(docs, str(tmp_path / "out"), shards=4, files_per_shard=2)
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r.row.id for r in back) == list(range(2000))
    for s in range(4):
        assert sorted(r.slot for r in back if r.shard == s) == list(range(500))


def test_sharding_is_uniform(spark):
    # Every input partition meets every shard and every half of a shard alike: chi-square
    # sums with 3 * 7 degrees of freedom over 30 seeds (mean 630, sd about 35.5).
    total = 0.0
    for seed in range(6):
        got = sharding.shuffle(spark.range(0, 4000, 1, 4), shards=4, seed=seed).collect()
        seen = np.zeros((4, 8))
        for r in got:
            seen[r.row.id // 1000, 2 * r.shard + (r.slot >= 500)] += 1
        total += ((seen - 125) ** 2 / 125).sum()
    assert 126 - 5 * 16 < total < 126 + 5 * 16


def test_matrix_draws():
    rng = np.random.default_rng(5)
    m = np.array([sharding.draw([5, 0, 7], [4, 4, 4], rng) for _ in range(4000)])
    assert (m.sum(2) == [5, 0, 7]).all() and (m.sum(1) == 4).all()
    # Hypergeometric: mean 5 * 4 / 12, variance 5 * 1/3 * 2/3 * 7/11.
    assert abs(m[:, 0, 2].mean() - 5 / 3) < .06 and abs(m[:, 0, 2].var() - 5 * 2 / 9 * 7 / 11) < .06
    big = np.array([sharding._large(rng, 3 * 10**10, 7 * 10**10, 10**9) for _ in range(3000)])
    sd = (10**9 * .3 * .7 * .99) ** .5
    assert abs(big.mean() - 3e8) < 5 * sd / 3000 ** .5 and .93 < big.std() / sd < 1.07
    small = Counter(sharding._large(rng, 4, 8, 5) for _ in range(20000))
    exact = Counter(rng.hypergeometric(4, 8, 5, 20000).tolist())
    assert all(abs(small[k] - exact[k]) < 500 for k in range(5))


def plain_phrases(rows, least, top):
    f, n = {}, Counter()
    for _, text, lang in rows:
        lang = lang if lang is not None else "und"
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] = f.get((lang, tuple(w[i:i + k])), 0) + 1
    out = []
    cand = {x: a for x, a in f.items() if a >= least and len(x[1]) > 1}
    for (lang, w), a in cand.items():
        if any(g == lang and len(v) > len(w) and 100 * b >= 80 * a and any(v[i:i + len(w)] == w for i in range(len(v))) for (g, v), b in cand.items()):
            continue
        score, _, l, r = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.append((lang, -score, -a, " ".join(w).encode(), l, r))
    got, place = [], Counter()
    for lang, s, a, w, l, r in sorted(out):
        place[lang] += 1
        if place[lang] <= top:
            got.append((lang, place[lang], w.decode(), -a, l, r, n[lang], -s))
    return got


def phrase_rows():
    rng = random.Random(4)
    vocabulary = ["the", "of", "New", "york", "city", "ÉTÉ", "été", "zum", "Beispiel", "x"]
    rows = [(None, None, None), (1, "", "en"), (1, " \t ", "en"), (2, "no phrases here", "fr")]
    for i in range(120):
        words = rng.choices(vocabulary, k=rng.randrange(1, 60))
        for k in range(0, len(words), 9):
            words[k:k + 3] = rng.choice((["New", "York", "City"], ["zum\tBeispiel  x", "of", "of of"], words[k:k + 3]))
        text = words[0]
        for w in words[1:]:
            text += rng.choice((" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r", " \x0b")) + w
        rows.append((i, text, rng.choice(("en", "de", "und", None, ""))))
    return rows + [(3, "of the of the of the of the", "de")] * 40


@pytest.mark.parametrize("least,top", [(30, 2000), (4, 25)])
def test_phrases(spark, least, top):
    rows = phrase_rows()
    got = phrases.collocations(frame(spark, rows), least=least, top=top)
    want = plain_phrases(rows, least, top)
    assert sorted(tuple(r)[:8] for r in got.collect()) == sorted(want) and want


def test_phrases_survive_collisions(spark, monkeypatch):
    # Fingerprints of six bits: nearly all collide, the counts stay exact.
    mix = phrases.W.mix
    rows = phrase_rows()
    monkeypatch.setattr(phrases.Runs, "fingerprints", lambda self, at, size: mix(
        ((self.prefix[at + size] - self.prefix[at]) * self.shift[at] ^ self.salt[self.text[at]]) >> np.uint64(58)))
    runs = phrases.Runs(np.frombuffer(b"a b c", np.uint8), np.array([0, 5]), np.zeros(1, np.uint64))
    assert list(runs.joined) == [True, True, False]
    got = phrases.collocations(frame(spark, rows), least=4, top=10**6)
    assert sorted(tuple(r)[:8] for r in got.collect()) == sorted(plain_phrases(rows, 4, 10**6))


def test_fingerprints_do_not_depend_on_place():
    text = b"a b c x a b c, a  b\tC"
    runs = phrases.Runs(np.frombuffer(text, np.uint8), np.array([0, len(text)]), np.zeros(1, np.uint64))
    h = runs.fingerprints(np.array([0, 4, 7]), 3)
    assert h[0] == h[1] == h[2] and len(set(runs.fingerprints(np.arange(8), 3).tolist())) == 6


def test_phrases_of_nothing(spark):
    docs = frame(spark, [(1, None, None), (2, "a b a b", "en")])
    assert phrases.collocations(docs).count() == 0 and phrases.collocations(docs.limit(0)).count() == 0


def test_pointers_lead_to_the_phrase(spark):
    rows = phrase_rows()
    docs = frame(spark, rows)
    texts = {r.h: r.text for r in docs.selectExpr("xxhash64(coalesce(text, '')) h", "text").collect()}
    for r in phrases.collocations(docs, least=10).collect():
        low = re.sub("[A-Z]", lambda m: m[0].lower(), texts[r.at_key])
        pieces = [" ".join(re.findall(r"[^\x20\x09]+", p)) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]
        assert any(f" {r.phrase} " in f" {p} " for p in pieces) and 1 <= r.cut < len(r.phrase.split(" "))
