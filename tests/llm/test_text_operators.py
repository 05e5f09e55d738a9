"""Exact duplicates, BPE, counts, SimHash and packing against libraries and brute force, odd inputs included."""

import base64
import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer

from surelake.llm import byte_bpe, exact_dedup, packing, simhash, token_count
from tests.conftest import SF

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, size long, part int"


def odd_texts() -> list:
    rnd = random.Random(5)
    signs = "ab  \n\t'sSé漢1２!?<|>̀​\xa0\x1c\x85😀aaa"
    made = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 50))) for _ in range(120)]
    made += ["".join(chr(rnd.choice([rnd.randrange(0x20, 0x300), rnd.randrange(0x300, 0xD7FF), rnd.randrange(0xE000, 0x1FFFF)])) for _ in range(30)) for _ in range(60)]
    long_one = " ".join(rnd.choice(["tion", "edly", "an,", "er.", "Thing"]) for _ in range(30_000))
    return [None, "", " ", "\n\n", "a<|endoftext|> b <|endoftext|>", "<|ENDOFTEXT|> x", "a" * 5000, "=-" * 2000, "x ", " x", long_one, "It's, We'LL. ΟΔΟΣ, İ.", "a  b", "a b", "ab", "A b", *made]


@pytest.fixture(scope="module")
def docs(spark):
    texts = odd_texts() + ["The same text."] * 40 + ["The  same\ttext."] * 3 + [None, ""]
    rows = [(n, t, None, "hot", None, "k", 1, 0) for n, t in enumerate(texts)]
    rows += [rows[-10], rows[-10], (None, "The same text.", None, None, None, None, None, None), (None, "no id", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


@pytest.mark.parametrize("limits", [{}, {"bucket_bytes": 200, "sample_per_bucket": 4}, {"bucket_bytes": 50, "most_buckets": 30}])
def test_exact_dedup(docs, limits):
    groups = defaultdict(list)
    for r in docs.collect():
        groups[squeezed(r.text)].append((-len(r.text or ""), r.doc_id is None, r.doc_id))
    got = exact_dedup.mark_duplicates(docs, **limits).collect()
    assert len(got) == docs.count()
    by_hash = {hashlib.sha256(k.encode()).hexdigest(): (min(v, key=lambda x: (x[0], x[1], x[2] or 0))[2], len(v)) for k, v in groups.items()}
    for r in got:
        assert (r.keep_id, r.group_size) == by_hash[r.text_sha256]
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)


def test_exact_dedup_keeps_rows_whole(docs, empty):
    kept = exact_dedup.keep_unique(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    assert sorted(squeezed(r.text) for r in kept.collect()) == sorted({squeezed(r.text) for r in docs.collect()})
    assert exact_dedup.mark_duplicates(empty).count() == 0 and exact_dedup.keep_unique(empty).count() == 0


@pytest.mark.parametrize("keep", [exact_dedup.keep_unique, simhash.keep_one_of_each])
def test_columns_may_have_any_names(spark, keep):
    rows = [(1, "one text of some words here", "a", "b", "c", 1, 2, "d.e"), (2, "one text of some words here", "f", "g", "h", 3, 4, "i"), (3, "quite another matter it is", None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id string, _sha string, sha string, n int, id int, `x.y` string")
    kept = keep(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect()), key=repr) == sorted([rows[0], rows[2]], key=repr)


def test_text_ids_may_hold_line_feeds(spark):
    rows = [(f"id\n{n}\n", "the same" if n % 3 else f"text {n}") for n in range(300)]
    got = exact_dedup.mark_duplicates(spark.createDataFrame(rows, "doc_id string, text string").repartition(4), bucket_bytes=50, most_buckets=100).collect()
    want = defaultdict(list)
    for i, t in rows:
        want[squeezed(t)].append(i)
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == sorted((i, min(v, key=lambda x: x), len(v)) for v in want.values() for i in v)


def test_other_vocabulary_files_are_refused(tmp_path):
    import json

    spec = json.load(open(P.path("byte_bpe_50k.json"), encoding="utf-8"))
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"model": {**spec["model"], "ignore_merges": True}}):
        path = tmp_path / "other.json"
        path.write_text(json.dumps({**spec, **change}))
        with pytest.raises(ValueError):
            token_count.Merger(str(path))


def test_counts_equal_the_library(docs, empty):
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = sorted((r.doc_id if r.doc_id is not None else -1, len((r.text or "").encode()), len(lib.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
    got = token_count.count_tokens(docs, P.path("byte_bpe_50k.json"), limit=100).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)
    assert token_count.count_tokens(empty, P.path("byte_bpe_50k.json")).count() == 0


def test_every_character_is_cut_like_the_library():
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json")).pre_tokenizer
    pattern = token_count.piece_pattern()
    for start in range(0, 0x30000, 64):
        text = "".join(f"a{chr(c)}a {chr(c)}1{chr(c)}" for c in range(start, start + 64) if not 0xD800 <= c < 0xE000)
        assert [m.span() for m in pattern.finditer(text)] == [span for _, span in lib.pre_tokenize_str(text)]


@pytest.fixture(scope="module")
def reference_encoding():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_tiktoken(docs, empty, reference_encoding):
    path = P.path("byte_bpe_50k.tiktoken")

    def row(r):
        ids = reference_encoding.encode_ordinary(r.text or "")
        return r.doc_id if r.doc_id is not None else -1, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()

    got = byte_bpe.round_trip(docs, path, P.PATTERN).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(map(row, docs.collect()))
    assert byte_bpe.round_trip(empty, path, P.PATTERN).count() == 0


def test_byte_bpe_offsets_and_decoding(docs, reference_encoding):
    path = P.path("byte_bpe_50k.tiktoken")
    encoded = byte_bpe.encode(docs.where("doc_id < 60 and doc_id <> 10"), path, P.PATTERN)
    texts = {r.doc_id: r.text or "" for r in docs.where("doc_id is not null").collect()}
    back = {r.doc_id: r.text for r in byte_bpe.decode(encoded, path, P.PATTERN).collect()}
    for r in encoded.collect():
        assert back[r.doc_id] == texts[r.doc_id]
        assert "".join(texts[r.doc_id][a:b] for a, b in zip(r.starts, r.ends)).startswith(texts[r.doc_id][:1])
        assert (r.starts[:1], r.ends[-1:]) == (([0], [len(texts[r.doc_id])]) if r.ids else ([], []))
    split = byte_bpe.codec(path, P.PATTERN)
    ids = reference_encoding.encode_ordinary("😀")
    assert len(ids) > 1 and split.decode(ids) == "😀".encode() and set(split.offsets("😀", ids)) == {(0, 1)}


def plain_fingerprint(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(codes, distance):
    names = sorted(codes)
    label = {c: c for c in names}

    def root(c):
        while label[c] != c:
            c = label[c]
        return c

    for i, a in enumerate(names):
        for b in names[:i]:
            if (a ^ b).bit_count() <= distance:
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {c: root(c) for c in names}


def near_rows(seed=3):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(12):
        base = [rnd.choice(words) for _ in range(150)]
        for _ in range(8):
            texts.append(" ".join(rnd.choice(words) if rnd.random() < 0.008 else w for w in base))
    return texts


def test_simhash_groups(spark, docs, empty):
    rows = [(n + 1000, t, None, None, None, None, None, None) for n, t in enumerate(near_rows())]
    both = docs.unionByName(spark.createDataFrame(rows, SCHEMA))
    given = both.collect()
    code = {(r.doc_id, r.text): plain_fingerprint(r.text) for r in given}
    parts = brute_components(set(code.values()), 4)
    first = defaultdict(list)
    for r in given:
        if r.doc_id is not None:
            first[parts[code[r.doc_id, r.text]]].append(r.doc_id)
    want = sorted((r.doc_id if r.doc_id is not None else -1, f"{code[r.doc_id, r.text]:016x}", min(first[parts[code[r.doc_id, r.text]]], default=-1)) for r in given)
    got = simhash.near_groups(both).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.fingerprint, r.component_id if r.component_id is not None else -1) for r in got) == want
    kept = simhash.keep_one_of_each(both)
    assert kept.columns == both.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted({w[2] for w in want} - {-1})
    assert simhash.near_groups(empty).count() == 0 and simhash.keep_one_of_each(empty).count() == 0


def test_one_of_each_component_stays_when_ids_are_missing_or_shared(spark):
    rnd = random.Random(11)
    prose = [" ".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") * rnd.randint(1, 9) for _ in range(80)) for _ in range(60)]
    rows = [(None, t) for t in prose[:40]] + [(7, t) for t in prose[40:50]] + [(100 + n, t) for n, t in enumerate(prose[50:])]
    rows += [(None, prose[0]), (None, prose[0].upper()), (None, prose[50]), (900, prose[41]), (7, prose[42]), (900, prose[3]), (None, None), (None, "")]
    frame = spark.createDataFrame([(i, t, None, None, None, None, n, None) for n, (i, t) in enumerate(rows)], SCHEMA)
    code = [simhash.fingerprint(t) for _, t in rows]
    root = brute_components(set(code), 4)
    best = {}
    for c, (i, t) in zip(code, rows):
        key = (i is None, i or 0, simhash.signed(c), t is not None, hashlib.sha256((t or "").encode()).hexdigest())
        best[root[c]] = min(best.get(root[c], (key, i, t)), (key, i, t), key=lambda x: x[0])
    kept = simhash.keep_one_of_each(frame)
    assert kept.schema.simpleString() == frame.schema.simpleString()
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(got, key=str) == sorted([(i, t) for _, i, t in best.values()], key=str)
    assert len(got) == len(best) == 61 and sum(i is None for i, _ in got) == 40 and sum(i == 7 for i, _ in got) == 10


@pytest.mark.parametrize("chunk", [2, 7, 4096])
def test_links_span_all_groups_when_routes_are_split(spark, chunk):
    rnd = random.Random(chunk)
    codes = set()
    for _ in range(4):
        centre = rnd.getrandbits(64)
        codes |= {centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 6))) for _ in range(30)}
    codes |= {rnd.getrandbits(64) for _ in range(50)} | {0, (1 << 64) - 1}
    frame = spark.createDataFrame([(simhash.signed(c),) for c in codes], "fp long")
    pairs = {(a % (1 << 64), b % (1 << 64)) for a, b in simhash.links(frame, 4, chunk).collect()}
    roots = {r.node % (1 << 64): r.root % (1 << 64) for r in simhash.components(simhash.links(frame, 4, chunk)).collect()}
    want = brute_components(codes, 4)
    assert all(want[a] == want[b] for a, b in pairs)
    groups = defaultdict(set)
    for c in codes:
        groups[roots.get(c, c)].add(want[c])
    assert all(len(v) == 1 for v in groups.values()) and len(groups) == len(set(want.values()))


def test_gray_rank_orders_the_gray_sequence():
    n = np.arange(1000, dtype=np.uint64)
    assert (simhash.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


@pytest.mark.parametrize("limits", [{}, {"room": 64, "range_bytes": 2000}])
def test_packing(docs, empty, limits):
    path, room = P.path("word_bpe_49k.json"), limits.get("room", 4096)
    lib = Tokenizer.from_file(path)
    want = defaultdict(list)
    for r in docs.collect():
        want[r.doc_id].append(np.array(lib.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4"))
    got = packing.pack(docs, path, **limits).collect()
    seen = defaultdict(list)
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append(r)
        choices = [ids for ids in want[r.doc_id] if len(ids) == r.doc_tokens and zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32]
        assert choices and r.length > 0
        seen[r.doc_id].append((r.start, r.length))
    for doc, all_ids in want.items():
        assert sum(n for _, n in seen[doc]) == sum(map(len, all_ids))
        if len(all_ids) == 1:
            assert sorted(seen[doc])[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(sorted(seen[doc]), sorted(seen[doc])[1:]))
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        total = sum(r.length for r in pieces)
        assert pieces[0].offset == 0 and all(a.offset + a.length == b.offset for a, b in zip(pieces, pieces[1:]))
        assert total <= room and total & (total - 1) == 0  # no padding at all
    assert packing.pack(empty, path).count() == 0


def test_hilbert_neighbours_touch(monkeypatch):
    monkeypatch.setattr(packing, "BITS", 2)
    monkeypatch.setattr(packing, "DIMS", 3)
    points = np.array([(a, b, c) for a in range(4) for b in range(4) for c in range(4)])
    keys = packing.hilbert_keys(points)
    path = points[np.argsort(keys)]
    assert sorted(keys) == list(range(64)) and (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_pieces_of_the_given_documents(spark):
    got = packing.pack(spark.read.parquet(f"{SF}/documents.parquet"), P.path("word_bpe_49k.json"))
    assert got.groupBy("doc_id", "doc_tokens").agg({"length": "sum"}).where("doc_tokens <> `sum(length)`").count() == 0
