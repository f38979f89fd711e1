"""Brute-force versions and edge cases of the training-data operators."""

import math
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from offerlake.llm import (ann, components, line_dedup, minhash_dedup, mixing, pieces, quality_crf, secret_scan, surrogates, toxicity, url_filter,
                           words)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "lang " * 30_000
#: null and empty texts, a repeated row, a null id, a very long text; clashing extra columns
EDGE = [(1, None, "a"), (2, "", "a"), (3, " \n\t", None), (4, "one", None), (4, "one", None), (None, "one two three", "b"), (5, LONG, "a"), (6, "Ünï çödé — 漢字 \U0001f600", "b")]
SCHEMA = "doc_id bigint, text string, source string, h string, node string, label string, row string, size int, spans string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w", 7, "v") for r in rows], SCHEMA)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{int(rng.paretovariate(0.8)) % vocabulary}" for _ in range(n))


def components_of(n, links):
    up = list(range(n))
    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        up[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(n)]


def test_word_hashes_match_plain_words():
    texts = ["a bb  A\tbb", "", None, "é漢 " + "x" * 200 + " " + "x" * 200]
    data, bounds = words.texts(pa.array(texts))
    starts, ends, first = words.spans(data, bounds, words.NOT_SPACE)
    got = words.hashes(data, starts, ends, words.LOWER)
    plain = [w for t in texts for w in (t or "").lower().encode().split()]
    assert [bytes(data[a:b]).lower() for a, b in zip(starts, ends)] == plain
    assert (got == words.hash_words(plain)).all() and len(set(got.tolist())) == len(set(plain))
    assert np.diff(first).tolist() == [4, 0, 0, 3]


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(60, 80)] + [(80, 80)]
    want = components_of(81, links)
    got = {r.node: r.label for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: want[x] for x in linked}


def brute_near(texts, size, percent):
    sets = [minhash_dedup.shingles(t, size) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    return [len(s) for s in sets], components_of(len(texts), links)


def test_near_duplicates(spark):
    rng = random.Random(1)
    texts = []
    for _ in range(12):
        base = prose(rng, rng.choice([1, 3, 12, 80])).split()
        for _ in range(rng.choice([1, 2, 14])):
            copy = list(base)
            for _ in range(rng.randrange(6)):
                copy[rng.randrange(len(copy))] = rng.choice(["new", "Other", "wörd"])
            texts.append(" ".join(copy).replace("w", rng.choice("wW")))
    texts += ["", None, "one", "One", texts[0]]
    for size in (2, 5):
        n, want = brute_near(texts, size, 80)
        out = minhash_dedup.near_duplicates(frame(spark, [(i, t, "s") for i, t in enumerate(texts)]), shingle=size)
        got = {r.doc_id: r for r in out.collect()}
        assert [got[i].n_shingles for i in range(len(texts))] == n
        assert [got[i].component_id for i in range(len(texts))] == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_block_sweep_finds_links_that_hubs_miss(spark):
    """A chain of copies: neighbours are links, the ends are not."""
    base = [f"t{i}" for i in range(60)]
    texts = []
    for k in range(40):
        texts.append(" ".join(base))
        base[k] = f"n{k}"
    _, want = brute_near(texts, 2, 80)
    got = minhash_dedup.near_duplicates(frame(spark, [(i, t, "s") for i, t in enumerate(texts)]), shingle=2).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(want)) and len(set(want)) == 1


def test_posterior_bound():
    # P(Bin(n + 1, t) <= m): pruning only when similarity >= t is less likely than the bound
    m = minhash_dedup.least_matches(30, 0.8, 1e-5)
    tail = lambda k: sum(math.comb(31, i) * 0.8**i * 0.2**(31 - i) for i in range(k + 1))
    assert tail(m) >= 1e-5 > tail(m - 1)


def test_near_duplicate_edges(spark):
    rows = minhash_dedup.near_duplicates(frame(spark, EDGE), shingle=2).collect()
    assert len(rows) == len(EDGE)
    by = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in rows)
    assert by == [(0, 2, None, True), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (4, 1, 4, True), (5, 1, 5, True), (6, 4, 6, True)]
    assert minhash_dedup.near_duplicates(frame(spark, EDGE).limit(0)).count() == 0


def test_line_dedup(spark):
    rng = random.Random(3)
    lines = [prose(rng, rng.choice([1, 4, 25, 40])) for _ in range(25)]
    near = [ln.replace("w1", "w1x", 1) for ln in lines]
    docs = [(i, "\n".join(rng.choice(rng.choice([lines, near, [""]])) for _ in range(6)), "s") for i in range(30)]
    every = sorted({ln for _, t, _ in docs for ln in t.split("\n") if ln.strip()})

    def shingle_set(line):
        u = line.encode("utf-16-be")
        n = max(1, len(u) // 2 - 7)
        return {u[2 * i:2 * i + 16] for i in range(n)}
    sets = [shingle_set(ln) for ln in every]
    links = [(i, j) for i in range(len(every)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    part = dict(zip(every, components_of(len(every), links)))
    seen, want = set(), {}
    for i, text, _ in docs:
        kept = []
        for ln in text.split("\n"):
            if not ln.strip() or part[ln] not in seen:
                kept.append(ln)
            if ln.strip():
                seen.add(part[ln])
        want[i] = "\n".join(kept)
    got = {r.row.doc_id: r for r in line_dedup.dedup_lines(frame(spark, docs)).collect()}
    assert {i: r.text for i, r in got.items()} == want and len(links) > 5
    assert all(r.n_lines - r.n_removed == sum(bool(x.strip()) for x in r.text.split("\n")) for r in got.values())


def line_shingles(line):
    u = line.encode("utf-16-be")
    return {u[2 * i:2 * i + 16] for i in range(max(1, len(u) // 2 - 7))}


def test_line_dedup_of_repetitive_lines(spark):
    """Leaders, rulers and table rows of many lengths: families with several hubs."""
    every = [f"Chapter {c}: Introduction{' ' * (c % 2)}" + "." * n for c in (1, 2) for n in (12, 20, 33, 60, 90)]
    every += ["| col |" + " --- |" * n for n in (4, 7, 12, 30)] + ["-" * n for n in (8, 40, 80, 200)] + ["=" * n for n in (9, 70)]
    every += [f"Section on the history of place {k} " + "." * n for k in "abc" for n in (10, 25, 70)]
    sets = [line_shingles(x) for x in every]
    links = [(i, j) for i in range(len(every)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    part = components_of(len(every), links)
    got = {r.row.doc_id: r.text for r in line_dedup.dedup_lines(frame(spark, [(i, x, "s") for i, x in enumerate(every)])).collect()}
    assert got == {i: x if part[i] == i else "" for i, x in enumerate(every)} and len(set(part)) < len(every) / 2


def test_line_dedup_sizes_are_of_sets(spark, monkeypatch):
    """The size filter of link_members is no bound for anything but the size of the set."""
    every = ["Chapter 1: Introduction" + "." * n for n in (12, 60)] + ["-" * n for n in (40, 80)] + ["| col |" + " --- |" * n for n in (4, 12)]
    class Seen(Exception):
        pass
    def members(df, *args, **kwargs):
        raise Seen(sorted(tuple(r) for r in df.select("node", "size", "reach").distinct().select("size", "reach").collect()))
    monkeypatch.setattr(line_dedup, "link_members", members)
    with pytest.raises(Seen) as seen:
        line_dedup.dedup_lines(frame(spark, [(i, x, "s") for i, x in enumerate(every)]))
    want = sorted(len(line_shingles(x)) for x in every)
    assert seen.value.args[0] == [(n, n) for n in want]


def test_line_dedup_recall_at_the_threshold(spark):
    """Pairs of lines with similarity 0.8 to 0.81: at most 1 in 500 shares no band (1e-4 expected)."""
    rng = random.Random(12)
    rows, least = [], 1.0
    for k in range(1500):
        a = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(152))
        b = a[:-16] + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(16))
        x, y = line_shingles(a), line_shingles(b)
        least = min(least, len(x & y) / len(x | y))
        rows += [(2 * k, a), (2 * k + 1, b)]
    assert 0.8 <= least < 0.81
    low = line_dedup.minima(*line_dedup.shingles([line for _, line in rows]))
    missed = few = 0
    for k in range(1500):
        same = [x == y for x, y in zip(low[2 * k], low[2 * k + 1])]
        missed += not any(all(same[p] for p in band) for band in line_dedup.BANDS)
        few += sum(same) < line_dedup.LEAST_EQUAL
    assert missed <= 3 and few <= 3


def test_line_dedup_edges(spark):
    out = line_dedup.dedup_lines(frame(spark, EDGE)).collect()
    got = sorted(((r.row.doc_id or 0), r.text, r.n_lines, r.n_removed) for r in out if r.text is not None)
    assert len(out) == len(EDGE)
    assert got == [(0, "one two three", 1, 0), (2, "", 0, 0), (3, " \n\t", 0, 0), (4, "one", 1, 0), (4, "one", 1, 0), (5, LONG, 1, 0), (6, EDGE[-1][1], 1, 0)]
    assert line_dedup.dedup_lines(frame(spark, EDGE).limit(0)).count() == 0


def test_line_shingles_are_sets_of_units():
    """Equal shingles and no others have equal hashes, short lines and surrogate pairs included."""
    rng = random.Random(5)
    every = ["".join(rng.choice("ab\U0001F600\0\u00e9") for _ in range(rng.choice([1, 2, 7, 8, 9, 40]))) for _ in range(300)]
    values, at = line_dedup.shingles(every)
    got = [set(values[at[i]:at[i + 1]].tolist()) for i in range(len(every))]
    want = [line_shingles(x) for x in every]
    assert [len(x) for x in got] == [len(x) for x in want]
    assert len(set().union(*got)) == len(set().union(*want))
    assert all(len(got[i] & got[j]) == len(want[i] & want[j]) for i in range(300) for j in range(i))


def test_line_dedup_of_large_buckets(spark, monkeypatch):
    """A large group of copies edited too much for each other, in pairs that are links: blocks find all."""
    monkeypatch.setattr(components, "SMALL_BUCKET", 4)
    monkeypatch.setattr(components, "PAIRS_PER_MEMBER", 0)
    monkeypatch.setattr(line_dedup, "LEFT", 8)
    monkeypatch.setattr(line_dedup, "RIGHT", 16)
    rng = random.Random(9)
    base = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(400))
    def edited(x, k):
        x = list(x)
        for at in rng.sample(range(len(x)), k):
            x[at] = rng.choice("0123456789")
        return "".join(x)
    every = []
    for _ in range(40):
        one = edited(base, 9)
        every += [one, edited(one, 2)]
    sets = [line_shingles(x) for x in every]
    links = [(i, j) for i in range(len(every)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    part = components_of(len(every), links)
    got = {r.row.doc_id: r.text for r in line_dedup.dedup_lines(frame(spark, [(i, x, "s") for i, x in enumerate(every)])).collect()}
    assert got == {i: x if part[i] == i else "" for i, x in enumerate(every)} and 20 < len(set(part)) < 60


def brute_quality(text):
    w = WORD.findall(text or "")
    windows, seen, dup = {}, set(), 0
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i:i + 8]), []).append(i)
    covered = {k for at in windows.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def test_quality_base_rules(spark):
    rng = random.Random(2)
    texts = ["\n".join(prose(rng, rng.randrange(30), 9) for _ in range(rng.randrange(8))) for _ in range(40)] + [r[1] for r in EDGE] + ["\n", "a\n\na\n", "| x |\n| x |"]
    out = quality_crf.judge(frame(spark, [(i, t, "s") for i, t in enumerate(texts)]), None).collect()
    for r in out:
        want = brute_quality(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r.kept == (not r.base_failed)
    assert quality_crf.judge(frame(spark, EDGE).limit(0), None).count() == 0


def test_viterbi_against_all_paths():
    rng = random.Random(4)
    for _ in range(30):
        emit, bonus = [rng.uniform(-2, 2) for _ in range(6)], rng.uniform(-1, 2)
        def value(path):
            return sum(e for e, s in zip(emit, path) if s) + bonus * sum(a and b for a, b in zip(path, path[1:]))
        best = max(value([(k >> i) & 1 for i in range(6)]) for k in range(64))
        assert value(quality_crf.viterbi(emit, bonus)) == pytest.approx(best)


def test_quality_field_learns(spark):
    rng = random.Random(9)
    good = [(". ".join(prose(rng, 12) for _ in range(3)) + ".\n" + prose(rng, 30) + ".", 1) for _ in range(60)]
    bad = [("\n".join("### %%% BUY NOW | | |" for _ in range(6)), 0) for _ in range(60)]
    field = quality_crf.fit(good + bad)
    rows = [(i, t, "s") for i, (t, _) in enumerate(good + bad)]
    got = {r.doc_id: r.content_share for r in quality_crf.judge(frame(spark, rows), field).collect()}
    assert all((got[i] >= 0.5) == bool(y) for i, (_, y) in enumerate(good + bad))


def test_marginals_equal_plain_forward_backward():
    rng = np.random.default_rng(1)
    field = toxicity.Field(np.arange(5, dtype=np.uint64), np.append(rng.normal(0, 2, 5), 0), np.zeros(65536, bool), -2.0, 1.3, np.zeros(4))
    for n in (1, 2, 7, 31):
        active = np.flatnonzero(rng.random(n) < 0.4)
        index = np.full((n, 2), 5)
        index[active, 0] = rng.integers(0, 5, len(active))
        emit = field.weights[index].sum(1) + field.bias
        p, _, _ = toxicity._forward_backward(emit[None, :], np.array([n]), field.bonus)
        assert toxicity.marginals(field, index[active], active, n) == pytest.approx(p[0, active], abs=1e-9)


def test_toxicity_learns_and_points_at_words(spark):
    rng = random.Random(7)
    rows = [(prose(rng, 40), 0) for _ in range(150)] + [(prose(rng, 20) + " Zonk, " + prose(rng, 5) + " blarg! " + prose(rng, 9), 1) for _ in range(50)]
    field = toxicity.fit(rows, 0.25)
    tests = [(1, "w1 w2 ZONK w3 blarg", "s"), (2, "w1 w2 w3", "s"), *[r for r in EDGE if r[0] != 5]]
    got = toxicity.score(frame(spark, tests), field).collect()
    assert got[0].predicted == 1 and got[0].spans == "6:10,14:19" and got[1].predicted == 0
    assert all(r.predicted == 0 and 0 <= r.score <= 1 for r in got[1:]) and len(got) == len(tests)
    assert {r.score for r in toxicity.score(frame(spark, tests), None).collect()} == {0.0}


def test_toxicity_never_trains_on_held_out(spark):
    import zlib
    docs = frame(spark, [(i, f"word{i} zonk" if i % 2 else f"word{i}", "s") for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, toxic int")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, flipped)
    assert (a.weights == b.weights).all() and a.bias == b.bias and (a.doc == b.doc).all()
    held = {r.doc_id for r in toxicity.score(docs, a).where("held_out").collect()}
    assert held == {i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert toxicity.train(docs, labels.limit(0)) is None


def brute_secrets(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    out = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in assign.finditer(text) if len(m.group(2)) >= 8]
    out += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    out += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return ",".join(x for *_, x in sorted(out))


def test_secrets(spark):
    rng = random.Random(6)
    parts = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "'", '"', " ", "  ", ":", "=", "AKIA", "akia", "ABCDEF0123456789", "abc", "é", "漢\n",
             "0123456789abcdef" * 2, "Z.", "-x_y/", "ghp_"]
    body = "".join(rng.choice("abcXYZ019") for _ in range(30)).encode()
    good = "ghp_" + (body + secret_scan.crc_base62(body)).decode()
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(400)]
    texts += [f"é {good} x", f"{good[:-1]}{'0' if good[-1] != '0' else '1'}", "card 4111 1111 1111 1111", "card 4111 1111 1111 1112", LONG + 'token="abcdefgh1"']
    texts += [r[1] for r in EDGE]
    got = {r.doc_id: r for r in secret_scan.find_secrets(frame(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    import hashlib
    for i, t in enumerate(texts):
        base = brute_secrets(t or "")
        assert ",".join(x for x in got[i].spans.split(",") if not x.startswith(("github", "card"))) == base
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert got[400].n_github == 1 and got[400].spans.startswith("github:2:42") and got[401].n_github == 0
    assert got[402].n_card == 1 and got[403].n_card == 0


def test_urls(spark):
    rules = spark.createDataFrame([*url_filter.RULES, (None, "/", "block"), ("a.b", "/x", "block"), ("a.b", "/x/y", "allow")], "host string, path string, verdict string")
    urls = {1: "http://www.EXAMPLE.com/en/1?x", 2: "https://m.example.com/en/25#top", 3: "http://example.com", 4: None, 5: "no scheme.com/en/", 6: "http://x.net/es/",
            7: "http://net/fr/z", 8: "http://notexample.com/en/", 9: "http://q.a.b/xx", 10: "http://a.b/x/yz", 11: "ftp://h?://com/", 12: "http://a..com//", 13: "", 14: "http://x.a.b/" + "x/" * 5000}
    pages = spark.createDataFrame([(i, u, "host", "digest") for i, u in urls.items()] + [(1, urls[1], "h", "d")], "page_id bigint, url string, host string, digest string")
    got = sorted((r.page_id, r.host, r.path[:9], r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect())
    assert got == [(1, "www.example.com", "/en/1", "www.example.com/en/", "allow"), (1, "www.example.com", "/en/1", "www.example.com/en/", "allow"),
                   (2, "m.example.com", "/en/25", "example.com/en/", "block"), (3, "example.com", "", None, "allow"), (4, "", "", None, "allow"), (5, "", "", None, "allow"),
                   (6, "x.net", "/es/", "net/es/", "block"), (7, "net", "/fr/z", "net/fr/", "block"), (8, "notexample.com", "/en/", "com/", "allow"),
                   (9, "q.a.b", "/xx", "a.b/x", "block"), (10, "a.b", "/x/yz", "a.b/x/y", "allow"), (11, "h", "", None, "allow"), (12, "a..com", "//", "com/", "allow"),
                   (13, "", "", None, "allow"), (14, "x.a.b", "/x/x/x/x/", "a.b/x", "block")]
    assert url_filter.judge(pages, rules.limit(0)).where("verdict <> 'allow' or rule is not null").count() == 0


def test_surrogates(spark):
    text = "Mail Ann.Lee7@Mail.example.com or ann.lee7@mail.EXAMPLE.com, +1 (743) 555-3824, 10.2.3.4, card 4111 1111 1111 1111. Dr. Anna Smith, Mr Smith, Иван Петров."
    rows = [(1, text, "s"), (2, text, "s"), *EDGE]
    got = [r for r in surrogates.replace(frame(spark, rows), b"k").collect()]
    new = got[0].text
    assert got[1].text == new and [r.text for r in got[2:]] == [r[1] for r in EDGE]
    old_mail, same_mail = re.findall(r"\S+@\S+com", new)
    assert old_mail.lower() == same_mail.lower() != "ann.lee7@mail.example.com" and old_mail[0].isupper()
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", new) and "743" not in new.split("+1")[1][:8] and "10.2.3.4" not in new
    card = re.search(r"card ([\d ]+)\.", new).group(1)
    assert secret_scan.luhn(card.replace(" ", "").encode()) and card != "4111 1111 1111 1111"
    first, last, again = re.search(r"Dr\. (\w+) (\w+), Mr (\w+)", new).groups()
    assert first.lower() in surrogates.GIVEN["latin", "f"] and last == again != "Smith"
    assert re.search(r"([А-Я][а-я]+) [А-Я][а-я]+ов\.", new).group(1).lower() in surrogates.GIVEN["cyrillic", "m"]
    assert surrogates.replace(frame(spark, rows), b"other").first().text != new
    assert surrogates.collisions(frame(spark, rows), b"k").count() == 0
    keyed = surrogates.Keyed(b"k")
    for n in (2, 3, 10, 257):
        p = [keyed.permuted(i, n, "t") for i in range(n)]
        assert sorted(p) == list(range(n)) and all(p[i] != i for i in range(n))
    cards = {f"411111{i:06d}{c}" for i in range(300) for c in "05"}
    assert len({surrogates.surrogate(keyed, "number", c, "") for c in cards}) == len(cards)


def test_surrogate_names_never_collide(spark):
    import itertools
    keyed = surrogates.Keyed(b"k")
    shape = ["".join(p) for p in itertools.product("aeiouy", surrogates.CLASSES[2], "aeiouy")]     # holds eva
    shape += ["".join(p) for p in itertools.product("bcd", "aeiouy", "o", surrogates.CLASSES[2])]  # may end in ov
    shape += [a + b + "ina" for a, b in itertools.product("irn", "rn")] + [a + b + "ина" for a, b in itertools.product("аеиоу", surrogates.CLASSES[4])]
    shape += [a + "ov" for a in ("sm", "br", "ab", "petr")]
    names = sorted({*shape, *surrogates._GENDER})
    new = {n: surrogates.surrogate(keyed, "name", n, "") for n in names}
    assert len(set(new.values())) == len(names) and all(n != x for n, x in new.items())
    assert all((n in surrogates._GENDER) == (x in surrogates._GENDER) for n, x in new.items())
    text = " ".join(f"Mr {n.capitalize()}." for n in names) + " At 10.2.3.4, 10.02.3.4."
    out = surrogates.replace(frame(spark, [(1, text, "s")]), b"k").collect()
    assert len(out) == 1 and out[0].n_entities == len(names) + 2
    assert len(set(re.findall(r"[\d.]+\d", out[0].text))) == 1


def plain_path(unit, table, first_byte, longest):
    best = [(0.0, 0, 0)]
    for hi in range(1, len(unit) + 1):
        steps = []
        for lo in range(max(0, hi - longest), hi):
            if unit[lo:hi] in table:
                i, score = table[unit[lo:hi]]
                steps.append((best[lo][0] + score, lo, -i))
            elif hi - lo == 1:
                steps.append((best[lo][0] - math.log(1e9), lo, 1))
        best.append(max(steps))
    out, hi = [], len(unit)
    while hi:
        _, lo, minus = best[hi]
        out = ([first_byte + b for b in unit[lo:hi].encode()] if minus == 1 else [-minus]) + out
        hi = lo
    return out


def test_pieces(spark):
    rng = random.Random(8)
    texts = [prose(rng, 40, 90), "  two  spaces \n\n new line", "unknown \U0001f9ff 漢字 \x01 ok", "the " * 3000, *[r[1] for r in EDGE if r[0] != 5]]
    docs = frame(spark, [(i, t, "s") for i, t in enumerate(texts)] + [(0, texts[0], "again")])
    rows, _, first_byte, longest = pieces.vocabulary()
    table = {p: (i, s) for p, i, s in rows}
    for head in (0, 50):
        out = pieces.encode(docs, head=head)
        got = out.collect()
        assert len(got) == len(texts) + 1 and all(r.round_trip for r in got)
        for r in got:
            t = texts[r.doc_id]
            norm = None if t is None else "▁" + t.replace(" ", "▁") if t else ""
            want = None if norm is None else [i for u in re.findall(pieces.UNIT, norm) for i in plain_path(u, table, first_byte, longest)]
            assert r.ids == want and r.n_pieces == len(want or [])
    assert {r.doc_id: r.text for r in pieces.decode(out).collect()} == dict(enumerate(texts))
    import sentencepiece
    public = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    assert all(public.decode(r.ids) == texts[r.doc_id] for r in got if r.ids and r.doc_id < 2)
    assert pieces.encode(docs.limit(0)).count() == 0


def test_pieces_of_parts():
    """No piece crosses a cut, and the parts' best paths make the unit's."""
    rng = random.Random(15)
    rows, _, first_byte, longest = pieces.vocabulary()
    table, pairs = {p: (i, s) for p, i, s in rows}, pieces.neighbours(rows)
    several = 0
    for _ in range(400):
        unit = pieces.SPACE * rng.choice([0, 1, 3]) + "".join(rng.choice(["the", "ing", "a", "q", "x", "\u00e7", ",", "#", ")", "\u6f22", "1", "="]) for _ in range(rng.randint(1, 9)))
        cut = pieces.parts(unit, pairs)
        several += len(cut) > 1
        assert "".join(cut) == unit and all(cut)
        assert [i for x in cut for i in plain_path(x, table, first_byte, longest)] == plain_path(unit, table, first_byte, longest)
    assert several > 200


def test_pieces_of_a_long_unit(spark):
    """Slices and runs of the folds have no seams: one unit of 6,000 characters, some without a piece."""
    rng = random.Random(5)
    unit = "".join(rng.choice(["a", "b", "th", "ing", "tion", "漢", "\U0001f9ff", "é", "\x01", "߷"]) for _ in range(2500)) + "=" * 3000
    rows, _, first_byte, longest = pieces.vocabulary()
    table = {p: (i, s) for p, i, s in rows}
    known = spark.createDataFrame(rows, "piece string, id int, score double")
    got = pieces.lattice(pieces.keyed(spark.createDataFrame([(unit,), ("a",), (unit,)], "unit string")), known, first_byte, longest).collect()
    assert sorted(len(r.ids) for r in got)[0] == 1 and len(got) == 2
    assert max((r.ids for r in got), key=len) == plain_path(unit, table, first_byte, longest)


def test_pieces_of_space_runs(spark):
    """Brute force over the model's own vocabulary and the whole text, without units."""
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    ordinary = [i for i in range(m.get_piece_size()) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
    table = {m.id_to_piece(i): (i, -math.log(i)) for i in ordinary}
    first_byte = next(i for i in range(m.get_piece_size()) if m.is_byte(i))
    texts = ["def f(x):\n        if x:\n            return 1\n\n    return  0", "a    b", "name      |  size   |\n" + " " * 40, " ", "  ", " " * 700 + "far \n " + "-" * 90,
             "▁▁ a ▁b", "\n  \n   漢字   end   "]
    texts += ["".join(random.Random(k).choice([" ", "  ", " " * 7, "\n", "if", "value", "x1", "é"]) for _ in range(60)) for k in range(6)]
    docs = frame(spark, [(i, t, "s") for i, t in enumerate(texts)])
    for head in (0, 1000):
        for r in pieces.encode(docs, head=head).collect():
            norm = "▁" + texts[r.doc_id].replace(" ", "▁")
            want = plain_path(norm, table, first_byte, max(map(len, table)))
            # Sums of one path differ by rounding with their order, so paths of equal score may differ.
            cost = [sum(math.log(i) for i in ids if not m.is_byte(i)) for ids in (r.ids, want)]
            assert cost[0] == pytest.approx(cost[1], rel=1e-12) and [i for i in r.ids if m.is_byte(i)] == [i for i in want if m.is_byte(i)]
            assert r.round_trip and m.decode(r.ids) == texts[r.doc_id].replace("▁", " ")
            assert r.doc_id != 1 or (r.ids == want and len(r.ids) == 3)


def test_mixing(spark):
    rng = random.Random(11)
    sources = ["b", "a", None, "", "é", "tiny"]
    rows = [(i, prose(rng, rng.choice([0, 1, 50, 300])), rng.choice(sources[:-1])) for i in range(300)] + [(900, "only three words", "tiny"), (901, None, "tiny"), (5, "twice here", "a"), (5, "twice here", "a")]
    docs = frame(spark, rows)
    got = mixing.taken(docs).collect()
    again = mixing.taken(docs.repartition(5)).collect()
    key = lambda r: (r.doc_id, r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again)) and len(got) == len(rows)
    size = {s: sum(len(WORD.findall(t or "")) for _, t, x in rows if x == s) for s in sources}
    order = sorted((s for s in sources if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, target, full = sum(size.values()), {}, set()
    while True:                                   # a source above its cap is set to it, the rest shared anew
        rest = total - sum(3 * size[s] for s in full)
        share = {s: 3 * size[s] if s in full else rest * weight[s] / sum(weight[x] for x in order if x not in full) for s in order}
        over = {s for s in order if s not in full and share[s] > 3 * size[s]}
        if not over:
            break
        full |= over
    for s in order:
        mine = [r for r in got if r.source == s]
        assert all(r.source_size == size[s] and r.target == pytest.approx(share[s]) and r.taken <= 3 * r.size for r in mine)
        assert abs(sum(r.taken for r in mine) - share[s]) <= 8
    assert mixing.taken(frame(spark, EDGE).limit(0)).count() == 0
    assert sum(r.taken for r in mixing.taken(frame(spark, EDGE)).collect()) > 0


def test_mix_spreads_repeated_rows(spark, monkeypatch):
    """Half of the rows have no doc_id, or are alike in everything: every row has a shuffle key of its own."""
    monkeypatch.setattr(mixing, "COPIES", 7)
    rows = [(None, f"text {i}", "s") for i in range(60)] + [(7, "same words", "s")] * 60 + [(i, "w", None) for i in range(20)]
    got = mixing._spread(frame(spark, rows).select("doc_id", "source", "text"), 1).collect()
    assert len(got) == len({r.shuffle for r in got}) == 140
    assert sorted(r.copy for r in got if r.doc_id == 7 and r.source == "s" and r.size == 2) == list(range(60))


def test_mix_takes_tiny_sources(spark):
    """Sources far below one block come as near their targets as the large ones."""
    rng = random.Random(2)
    rows = [(i, "w " * 400, "big" if i % 2 else "large") for i in range(60)] + [(100 + k, "t " * rng.randrange(1, 40), f"s{k:02}") for k in range(40)]
    documents, parts = mixing.mix(frame(spark, rows), block_words=1024, slots=1)
    taken = {r.row: r.n for r in parts.groupBy("row").agg(F.sum(F.col("to") - F.col("from")).alias("n")).collect()}
    got, target = {}, {}
    for r in documents.collect():
        got[r.source] = got.get(r.source, 0) + taken.get(r.row, 0)
        target[r.source] = r.target
    assert len(target) == 42 and all(abs(got[s] - target[s]) <= 1 for s in target)
    assert parts.groupBy("slot").agg(F.sum(F.col("to") - F.col("from")).alias("n")).where("n > 1024").count() == 0
    assert parts.groupBy("slot").agg(F.countDistinct("block").alias("n")).where("n > 1").count() == 0


def test_mix_pieces_cover_slots(spark):
    rows = [(i, prose(random.Random(i), 40), "ab"[i % 2]) for i in range(30)]
    documents, parts = mixing.mix(frame(spark, rows), block_words=32, slots=1)
    got = parts.groupBy("slot").agg(F.sum(F.col("to") - F.col("from")).alias("n"), F.countDistinct("block").alias("blocks")).collect()
    assert sum(r.n for r in got) <= 1200 and all(r.n <= 32 and r.blocks == 1 for r in got) and sum(r.n == 32 for r in got) >= len(got) - 2
    # Low discrepancy: every prefix of the schedule holds each source's share.
    place = {r.row: r.source for r in documents.collect()}
    slots = sorted({(r.slot, place[r.row]) for r in parts.collect()})
    for n in range(1, len(slots)):
        assert abs(sum(s == "a" for _, s in slots[:n]) - n * 5 / 7) <= 3


def test_ann(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((600, 16)).astype(np.float32)
    x[100:160] = x[100]                            # copies: ties by id
    x *= rng.uniform(0.5, 2, (600, 1)).astype(np.float32)
    x[100:160] = x[100]
    rows = [(i, [float(v) for v in x[i]], "l") for i in range(600)]
    odd = [(700, None, "l"), (720, [0.0] * 16, "l"), (740, [float("nan")] + [1.0] * 15, "l"), (760, [1.0] * 3, "l"), (None, [1.0] * 16, "l"), (780, [None] + [1.0] * 15, "l")]
    data = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>, v string")
    got = ann.nearest(data, F.col("vec_id") % 20 == 0).collect()
    hits = 0
    d = x.astype(np.float64)
    for q in range(0, 600, 20):
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, *_ in mine] == list(range(1, 21))
        exact = (d * d[q]).sum(1)
        assert all(s == pytest.approx(exact[v], abs=1e-12) for _, v, s in mine) and all(v != q for _, v, _ in mine)
        assert [v for _, v, _ in mine] == sorted((v for _, v, _ in mine), key=lambda v: (-exact[v], v))
        want = sorted((i for i in range(600) if i != q), key=lambda i: (-exact[i], i))[:20]
        hits += len(set(want) & {v for _, v, _ in mine})
    assert hits >= 0.9 * 30 * 20 and {r.query_id for r in got} == set(range(0, 600, 20))
    few = spark.createDataFrame(rows[:3] + rows[:1], "vec_id bigint, embedding array<float>, v string")
    assert sorted((r.query_id, r.rank) for r in ann.nearest(few, F.col("vec_id") == 0).collect()) == [(0, 1), (0, 1), (0, 2), (0, 2), (0, 3), (0, 3)]
    assert ann.nearest(data.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_toxicity_training_keeps_little_memory(monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 2)
    rng = random.Random(4)
    rows = [(" ".join(f"w{rng.randrange(3000)}" for _ in range(300)) + (" vile" if y else ""), y) for y in (0, 1) for _ in range(200)]
    toxicity.fit(rows[:20] + rows[-20:], None)
    tracemalloc.start()
    toxicity.fit(rows, None)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak / (400 * 300) < 100          # bytes per word; 149 with every text's features kept


def test_pieces_keys_of_units(spark):
    """A unit shorter than a hash is its own key; long ones, and texts that look like a key, are told apart."""
    rows, _, first_byte, longest = pieces.vocabulary()
    table = {p: (i, s) for p, i, s in rows}
    known = spark.createDataFrame(rows, "piece string, id int, score double")
    units = ["a", "ab" * 15 + "c", "é" * 15 + "c", "é" * 16, "0123456789ABCDEF" * 2, "é" * 16 + "d", "word" * 40]
    keyed = pieces.keyed(spark.createDataFrame([(u,) for u in units * 3], "unit string"))
    keys = {r.unit: r.key for r in keyed.collect()}
    assert all((keys[u] == u) == (len(u.encode()) < pieces.KEY) for u in units)
    assert len(set(keys.values())) == len(units) and all(len(k) == pieces.KEY for u, k in keys.items() if k != u)
    # Shuffled without loss: one row per unit, whose ids are those of the whole unit.
    again = pieces.keyed(spark.createDataFrame([(k,) for k in keys.values()], "unit string"))
    got = {r.key: r.ids for r in pieces.lattice(keyed.union(again), known, first_byte, longest).collect()}
    want = {r.key: plain_path(r.unit, table, first_byte, longest) for r in keyed.union(again).distinct().collect()}
    assert got == want
