"""Repeated passages, spelling variants and periodic runs against brute force, odd inputs included."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from surelake.llm import period_runs, spelling, suffix_dedup
from tests.conftest import SF

SCHEMA = "doc_id long, text string, lang string, gram long, k1 long, spans int, word string"


def frame(spark, texts, ids=None):
    rows = [(n if ids is None else ids[n], t, None, 1, 2, 3, "x") for n, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


# Repeated passages

def test_suffix_array():
    rnd = random.Random(1)
    for _ in range(400):
        s = [rnd.randint(0, rnd.choice([0, 1, 2, 5])) for _ in range(rnd.randint(0, 60))]
        assert suffix_dedup.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def removed(texts, length):
    """(removed bytes, spans, kept bytes) of each text, by a dictionary of all strings."""
    raws = [(t or "").encode() for t in texts]
    starts = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if starts[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        yield sum(gone), spans, bytes(c for c, g in zip(r, gone) if not g)


def passages(rnd, alphabet, n_docs, length):
    """Texts with shared passages, near copies of one text, periodic stretches and odd ones."""
    made = lambda n: "".join(rnd.choice(alphabet) for _ in range(n))
    shared = [made(rnd.randint(length, 3 * length)) for _ in range(5)]
    base = made(12 * length)
    texts = [None, "", "a" * (length - 1), "a" * length, "a" * (4 * length), "ab" * (2 * length), base, base]
    while len(texts) < n_docs:
        kind = rnd.random()
        if kind < 0.4:
            texts.append("".join(made(rnd.randint(0, 2 * length)) + rnd.choice(shared) for _ in range(rnd.randint(1, 3))))
        elif kind < 0.8:
            near = list(base)
            for _ in range(rnd.randint(1, 12)):
                near[rnd.randrange(len(near))] = rnd.choice(["", "é", "z", made(3)])
            texts.append("".join(near))
        else:
            texts.append(made(rnd.randint(0, 4 * length)))
    return texts


@pytest.mark.parametrize("length, alphabet, limits", [
    (9, "ab", {}), (16, "abcd", {"most_contexts": 3}), (24, "abcé", {"hot_share": 0.0}), (24, "abc", {"hot_share": 0.0, "most_contexts": 2}), (200, "abcdef ", {}),
])
def test_removed_passages(spark, monkeypatch, length, alphabet, limits):
    rnd = random.Random(length)
    texts = passages(rnd, alphabet, 60, length)
    monkeypatch.setattr(suffix_dedup, "PIECE", 50)
    got = suffix_dedup.remove_repeats(frame(spark, texts), length=length, **limits).collect()
    assert len(got) == len(texts)
    want = list(removed(texts, length))
    for r in got:
        assert (r.n_removed, r.n_spans, bytes(r.kept)) == want[r.doc_id]
        assert r.n_bytes == len((texts[r.doc_id] or "").encode()) and sum(s.high - s.low for s in r.spans) == r.n_removed


def test_contexts_of_one_task():
    rnd = random.Random(4)
    for _ in range(60):
        length = rnd.choice([8, 11, 30])
        core, flank = length // 2, length - length // 2
        groups, lefts, rights = [], [], []
        for g in range(rnd.randint(1, 4)):
            for _ in range(rnd.randint(1, 12)):
                l = rnd.randint(0, flank)
                groups.append(g)
                lefts.append(bytes(rnd.choice(b"ab") for _ in range(l)))
                rights.append(bytes(rnd.choice(b"ab") for _ in range(rnd.randint(flank - l, flank))))
        twice = [rnd.random() < 0.2 for _ in groups]
        got = suffix_dedup.repeated_runs(groups, lefts, rights, twice, length)
        strings = Counter()
        for g, a, b, t in zip(groups, lefts, rights, twice):
            for k in range(max(0, flank - len(b)), len(a) + 1):
                strings[g, k, a[len(a) - k :], b[: flank - k]] += 1 + t
        for g, a, b, runs in zip(groups, lefts, rights, got):
            starts = {k for most, least in runs for k in range(least, most + 1)}
            assert starts == {k for k in range(max(0, flank - len(b)), len(a) + 1) if strings[g, k, a[len(a) - k :], b[: flank - k]] > 1}
        assert core + flank == length


def test_removal_digests_and_odd_tables(spark):
    empty = frame(spark, [])
    assert suffix_dedup.remove_repeats(empty).count() == 0
    long_one = " ".join(str(n) for n in range(300_000))
    texts = [long_one, "x" * 300, long_one[1000:5000], None, "x" * 300]
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(frame(spark, texts, [0, None, 2, 3, 4]), digest=True).collect()}
    assert got[0].n_removed == 4000 and got[2].n_removed == 4000 and got[None].n_removed == 300 == got[4].n_removed
    assert got[0].kept_sha256 == hashlib.sha256((long_one[:1000] + long_one[5000:]).encode()).hexdigest()
    assert (got[3].n_bytes, got[3].n_spans) == (0, 0)


# Spelling variants

def counted(texts, ids, misspell):
    out = Counter()
    for doc, text in zip(ids, texts):
        for w in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            w = "".join(c.lower() if c.isascii() else c for c in w)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{w}".encode())
            if misspell and h % misspell == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            out[w] += 1
    return out


def is_near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1 :] == b for k in range(len(a)))


def grouped(counts):
    words = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    near = defaultdict(set)
    masks = defaultdict(list)
    for w in words:
        for k in range(len(w)):
            masks[w[:k], w[k + 1 :]].append(w)
            masks[w[:k] + w[k + 1 :]].append(w)
        masks[w].append(w)
    for alike in masks.values():
        for a in alike:
            near[a].update(b for b in alike if is_near(a, b))
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        yield w, form[w], root, n, len(near[w]), form[w] and words[form[w]]


@pytest.mark.parametrize("seed, limits", [(1, {}), (2, {"list_goal": 3}), (3, {"list_goal": 8, "most_grams": 20}), (4, {"list_goal": 2, "list_rows_at_once": 5})])
def test_word_groups(spark, seed, limits):
    rnd = random.Random(seed)
    parts = ["th", "er", "in", "a", "ab", "tion", "é", "ö", "aaa", "x", "Ł", "漢"]
    words = {"".join(rnd.choice(parts) for _ in range(rnd.randint(2, 6))) for _ in range(150)}
    for w in list(words):
        for _ in range(rnd.randint(0, 3)):
            k = rnd.randrange(len(w))
            words.add(w[:k] + rnd.choice(["", "e", "t", "zq", "é"]) + w[k + rnd.randint(0, 1) :])
    words |= {"a" * 5, "a" * 6, "a" * 7, "ab" * 200, "ab" * 199 + "a", "ab" * 100 + "x" + "ba" * 100}
    counts = {w: rnd.choice([2, 3, 3, 5, 6, 12, 40, 100]) for w in sorted(words)}
    rows = [(w, n - 1) for w, n in counts.items()] + [(w, 1) for w in counts] + [(None, 9), ("nullcount", None)]
    got = spelling.group_variants(spark.createDataFrame(rows, "word string, n long").repartition(3), **limits).collect()
    assert sorted(map(tuple, got)) == sorted(grouped(counts))


def test_grams_left_by_an_edit():
    """No word one letter shorter or replaced keeps fewer grams than the bound says."""
    rnd = random.Random(6)
    for _ in range(60):
        words = ["".join(rnd.choice("aab" if rnd.random() < 0.5 else "abc") for _ in range(rnd.randint(5, 12))) for _ in range(20)]
        places = Counter(w[p : p + q] for w in words for q in range(2, 6) for p in range(len(w) - q + 1))
        least = rnd.choice([1, 4, 10])
        grams = spelling.Grams({g: n for g, n in places.items() if n > least})
        for w in words:
            for q in spelling.LEVELS:
                own = grams.cut(w, q)
                left = len(own) - grams.spoiled(w, own, q)
                for k in range(len(w)):
                    for new in ("", "a", "b", "c"):
                        v = w[:k] + new + w[k + 1 :]
                        other = {(p, v[p:e]) for p, e in grams.cut(v, q)}
                        shift = 1 - len(new)
                        kept = sum((p, w[p:e]) in other or (p - shift, w[p:e]) in other for p, e in own)
                        assert kept >= left


def test_lists_asked_are_the_shortest():
    """A word's grams are cut once, and levels that can't have shorter lists are passed over."""
    rnd = random.Random(9)
    passed = 0
    for _ in range(40):
        words = {"".join(rnd.choice("aabc") for _ in range(rnd.randint(5, 14))) for _ in range(30)}
        places = Counter(w[p : p + q] for w in words for q in range(2, 6) for p in range(len(w) - q + 1))
        grams = spelling.Grams({g: n for g, n in places.items() if n > 3})
        for w in words:
            costs = {}
            cuts = {q: grams.cut(w, q) for q in spelling.LEVELS if q == 2 or 2 * q <= len(w)}
            for q, own in cuts.items():
                n = grams.spoiled(w, own, q) + 1
                if n <= len(own):
                    costs[q] = sum(sorted(grams.counts.get(w[p:e], 3) for p, e in own)[:n])
            tried = []
            grams.spoiled = lambda *a: tried.append(a) or spelling.Grams.spoiled(grams, *a)
            q, asked = grams.asks(w, 3, cuts)
            del grams.spoiled
            passed += len(cuts) - len(tried)
            assert set(asked) <= set(cuts[q]) and len(asked) == grams.spoiled(w, cuts[q], q) + 1
            assert sum(grams.counts.get(w[p:e], 3) for p, e in asked) == costs[q] == min(costs.values())
    assert passed > 100


@pytest.mark.parametrize("size", [1, 5, 9, 127, 128, 254, 255, 256, 400])
def test_pairs_by_plain_loops(size):
    rnd = random.Random(size)
    base = [rnd.choice("ab") * size, "".join(rnd.choice("ab") for _ in range(size))]

    def edited(w, extra):
        w = list(w)
        for _ in range(rnd.randint(0, 2)):
            w[rnd.randrange(size)] = rnd.choice("abc")
        for _ in range(extra):
            w.insert(rnd.randint(0, len(w)), rnd.choice("abc"))
        return "".join(w)

    right = [edited(rnd.choice(base), 0) for _ in range(12)]
    for extra, near in ((0, spelling.one_replaced), (1, spelling.one_deleted)):
        left = [edited(rnd.choice(base), extra) for _ in range(15)]
        grids = [np.array([list(w.encode()) for w in ws], np.uint8) for ws in (left, right)]
        want = {(i, j) for i, a in enumerate(left) for j, b in enumerate(right) if is_near(a, b)}
        assert set(zip(*(c.tolist() for c in near(*grids)))) == want


def test_counted_words(spark):
    rnd = random.Random(7)
    letters = "aAzZéÉÀÿ×÷ -'1漢Łı\u0301\xbf"
    texts = [None, "", "÷×÷×÷ a", "A" * 100_000, *("".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(150))]
    ids = [None, *range(1, len(texts) - 1), 3]
    for misspell in (0, 1, 3):
        got = spelling.count_words(frame(spark, texts, ids), least_letters=1, misspell=misspell, most_held=20)
        assert {r.word: r.n for r in got.collect()} == {w: n for w, n in counted(texts, ids, misspell).items() if w}
    empty = frame(spark, [])
    assert spelling.variant_groups(empty).count() == 0
    got = spelling.variant_groups(frame(spark, ["where wheree where wheree wheree where " * 4, "wherre " * 3, "Were " * 3]))
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got.collect()} == {
        "where": (None, "where", 12, 2, None), "wheree": (None, "wheree", 12, 2, None), "wherre": ("where", "where", 3, 2, 12),
    }


# Periodic runs

def runs(w, least=12):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def periodic(rnd):
    kind = rnd.random()
    if kind < 0.3:
        return [rnd.randint(0, rnd.choice([0, 1, 1, 2, 4])) for _ in range(rnd.randint(0, 90))]
    w = []
    while len(w) < rnd.randint(10, 150):
        if kind < 0.7:
            p = [rnd.randint(0, 2) for _ in range(rnd.randint(1, 14))]
            w += (p * rnd.randint(1, 7))[: rnd.randint(1, 80)]
        else:  # words in words, as in Fibonacci strings
            w = w + [rnd.randint(0, 2)] * rnd.randint(0, 3) + w[: rnd.randint(0, len(w))]
    return w


def test_runs_of_sequences():
    rnd = random.Random(8)
    for _ in range(500):
        docs = [periodic(rnd) for _ in range(rnd.randint(1, 4))]
        codes, counts = np.array([c for d in docs for c in d], np.int64), np.array([len(d) for d in docs])
        first = np.concatenate([[0], np.cumsum(counts)])
        start, end, period = period_runs.runs_of(codes, counts)
        for k, d in enumerate(docs):
            own = (start >= first[k]) & (start < first[k + 1])
            assert sorted(zip(start[own] - first[k], (end - start)[own], period[own])) == runs(d)


def test_collapsed_runs(spark):
    rnd = random.Random(9)
    spaces = [" ", "  ", "\t", "\r\n", "\x0b "]
    texts = [None, "", " \n", "a " * 5000, "a\xa0b " * 20, "x " * 11, "x " * 12]
    texts += ["".join(f"w{c}" + rnd.choice(spaces) for c in periodic(rnd)) for _ in range(80)]
    ids = [None, *range(1, len(texts) - 1), 5]
    for planted in (False, True):
        got = period_runs.run_digests(frame(spark, texts, ids), planted=planted).collect()
        want = []
        for doc, text in zip(ids, texts):
            w = (text or "").translate({c: " " for c in range(9, 14)}).split(" ")
            w = [x for x in w if x]
            h = zlib.crc32(("null" if doc is None else str(doc)).encode())
            if planted and h % 10 == 0 and w:
                a = h // 10 % len(w)
                p = 1 + (len(w) - a) // (3 + h // 10 % 8)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
            found = runs(w)
            dropped = {i for s, n, q in found for i in range(s + q, s + n)}
            best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
            lines = "".join("%d,%d,%d\n" % r for r in sorted(found, key=lambda r: (r[0], r[2])))
            kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
            want.append((doc, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept))))
        assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))
    per_run = period_runs.find_runs(frame(spark, texts, list(range(len(texts)))))
    by_doc = defaultdict(list)
    for r in per_run.collect():
        by_doc[r.doc_id].append((r.start, r.length, r.period))
    for n, text in enumerate(texts):
        assert sorted(by_doc[n]) == runs((text or "").translate({c: " " for c in range(9, 14)}).replace("\xa0", "_").split())
    assert period_runs.run_digests(frame(spark, [])).count() == 0 and period_runs.find_runs(frame(spark, [])).count() == 0


def test_new_queries_on_given_tables(spark):
    from surelake.llm import registry

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in registry.op11_suffix_dedup(spark, SF).collect()}
    for doc, (n, spans, kept) in zip(docs, removed(docs.values(), 200)):
        r = got[doc]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len((docs[doc] or "").encode()), n, spans, hashlib.sha256(kept).hexdigest())
    words = registry.op12_spelling(spark, SF).collect()
    assert sorted(map(tuple, words)) == sorted(grouped(counted(docs.values(), docs, 97)))
    assert len(got) == len(docs) == registry.op13_period_runs(spark, SF).count()
