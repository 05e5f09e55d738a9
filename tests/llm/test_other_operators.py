"""Classifiers, chat windows, url verdicts, top-k and the pipeline, odd inputs included."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer
from pyspark.sql import functions as F

import corpus_pipeline
from surelake.llm import chat, exact_dedup, packing, quality, registry, simhash, topk, toxicity, url_filter
from tests.compare import compare, duck
from tests.conftest import SF

DOCS = "doc_id long, text string, lang string, source string, n_chars long, label int, counts string"
MID = "/root/testdata/sf0.1"


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_queries_equal_their_sql(spark, name):
    assert compare(registry.QUERIES[name](spark, SF), duck(SF), registry.SQL[name]) is None


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.mark.parametrize("operator,column,positive", [(quality, "quality", 1), (toxicity, "toxic", 1)])
def test_classifier_on_the_held_out_fold(spark, operator, column, positive):
    docs, labels = (spark.read.parquet(f"{MID}/{t}.parquet") for t in ("documents", "labels"))
    # the label column of held-out rows is turned round: nothing may be learned from them
    turned = labels.withColumn(column, F.when(quality.held_out(), 1 - F.col(column)).otherwise(F.col(column)))
    wanted = {r.doc_id: r[column] for r in labels.collect()}
    got = operator.score(docs.select("doc_id", "text"), turned)
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.held_out == held(d) for d, r in rows.items())
    scored = [(rows[d].score, y) for d, y in wanted.items() if held(d)]
    ones, zeros = ([s for s, y in scored if y == k] for k in (1, 0))
    auc = np.mean([(a > b) + (a == b) / 2 for a in ones for b in zeros])
    assert auc > (0.98 if operator is quality else 0.85)


def tiny(spark):
    good = [(n, f"plain words of a calm text number {n} that goes on.", "en", "s", None, None, None) for n in range(60)]
    bad = [(100 + n, f"you {w} {w}!!! what a {w} {w}!!! {n}", "en", "s", None, None, None) for n, w in enumerate(["grumbler", "snorter"] * 30)]
    odd = [(500, None, None, None, None, None, None), (501, "", "", "", 0, 0, ""), (502, " \n", None, None, None, None, None), (None, "no id", None, None, None, None, None), (503, "x" * 200_000, None, None, None, None, None)]
    docs = spark.createDataFrame(good + bad + odd + odd[:1], DOCS)
    labels = spark.createDataFrame([(n, 1, 0) for n in range(60)] + [(100 + n, 0, 1) for n in range(60)] + [(None, 1, 1), (7, None, None), (7, 1, 0), (9999, 1, 1)], "doc_id long, quality int, toxic int")
    return docs, labels


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_classifier_on_odd_rows(spark, operator):
    docs, labels = tiny(spark)
    got = operator.score(docs, labels)
    assert got.columns == [*docs.columns, "held_out", "score", "predicted"] and got.count() == docs.count()
    rows = {r.doc_id: r for r in got.collect()}
    flip = 1 if operator is quality else 0
    assert np.mean([rows[n].predicted == flip for n in range(60)]) > 0.95
    assert np.mean([rows[100 + n].predicted != flip for n in range(60)]) > 0.95
    assert rows[500].predicted == rows[501].predicted == flip
    again = operator.score(docs.drop("counts").withColumn("score", F.lit("x")).repartition(3), labels)
    assert {(r.doc_id, round(r.score, 9)) for r in again.collect()} == {(r.doc_id, round(r.score, 9)) for r in got.collect()}
    none = operator.score(docs, labels.where("doc_id = -1"))
    assert none.count() == docs.count() and all(0 <= r.score <= 1 for r in none.collect())
    assert operator.score(docs.limit(0), labels).count() == 0


def test_misspelt_words_share_vectors():
    rnd = random.Random(2)
    plain = ["".join(rnd.choice(["ta", "lo", "ri", "men", "su", "ke"]) for _ in range(rnd.randint(1, 4))) for _ in range(400)]
    texts, labels = [], []
    for n in range(400):
        words = [rnd.choice(plain) for _ in range(60)]
        if n % 2:
            for _ in range(3):
                words[rnd.randrange(60)] = rnd.choice(["blockhead", "numbskull", "dimwitted"])
        texts.append(" ".join(words))
        labels.append(n % 2)
    model = toxicity.Model()
    model.fit(texts[:300], np.array(labels[:300]))
    model.calibrate(model.logits(texts[300:], model.word_table()), np.array(labels[300:]))
    clean = " ".join(rnd.choice(plain) for _ in range(60))
    scores = model.score([clean, clean + " blockhed", clean + " numbskul!", "dimwited " + clean])
    assert scores[0] < 0.5 < scores[1:].min()


def test_loss_gradients_and_logits_by_plain_loops():
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(["able", "baker", "charlie", "dog-eared", "easy"]) for _ in range(n)) for n in (1, 2, 3, 4, 9, 30)]
    words = sorted({w for t in texts for w in t.split()})
    size, grams = toxicity.gram_ids(words)
    bucket, local = np.unique(grams, return_inverse=True)
    rng = np.random.default_rng(1)
    e, out, bias = rng.standard_normal((4, len(bucket))), rng.standard_normal((2, 4)), rng.standard_normal(2)
    y, weight = np.array([0, 1, 0, 1, 1, 0.0]), np.arange(1, 7) / 21
    batch = toxicity.Batch([np.array([words.index(w) for w in t.split()]) for t in texts], y, weight, local, toxicity.offsets_of(size), size)
    first = toxicity.offsets_of(size)
    vec = {w: e[:, local[first[k] : first[k + 1]]].mean(axis=1) for k, w in enumerate(words)}
    for mean in (True, False):
        want = 0.0
        for t, label, share in zip(texts, y, weight):
            w = t.split()
            windows = [w[k : k + 3] for k in range(max(1, len(w) - 2))]
            z = [float((out[1] - out[0]) @ (sum(vec[x] for x in win) / 3) + bias[1] - bias[0]) for win in windows]
            pooled = math.log(sum(math.exp(v) for v in z) / (len(z) if mean else 1))
            want += share * (math.log1p(math.exp(pooled)) - label * pooled)
        loss, grads = batch.loss(e, out, bias, mean)
        assert abs(loss - want) < 1e-9
        for p, g in zip((e, out, bias), grads):
            for _ in range(12):
                at = tuple(rnd.randrange(n) for n in p.shape)
                kept, p[at] = p[at], p[at] + 1e-5
                up = batch.loss(e, out, bias, mean)[0]
                p[at] = kept - 1e-5
                down = batch.loss(e, out, bias, mean)[0]
                p[at] = kept
                assert abs((up - down) / 2e-5 - g[at]) < 1e-5
    model = toxicity.Model()
    model.grams[:, bucket], model.out, model.bias = np.zeros((6, len(bucket))), np.zeros((2, 6), np.float32), bias
    model.grams[:4, bucket], model.out[:, :4] = e, out
    for t, z in zip(texts, model.logits(texts, model.word_table())):
        w = t.split()
        assert abs(z - max(float((out[1] - out[0]) @ (sum(vec[x] for x in w[k : k + 3]) / 3) + bias[1] - bias[0]) for k in range(max(1, len(w) - 2)))) < 1e-4
    assert model.logits([None, "", " .,;"], model.word_table()).tolist() == [-20.0] * 3


def test_votes_by_plain_loops():
    rng = np.random.default_rng(2)
    counts = rng.random((60, quality.WIDTH)).astype(np.float32) * (rng.random((60, quality.WIDTH)) < 0.02)
    labels = rng.integers(0, 2, 60)
    votes = quality.Votes(counts.copy(), labels, 0.4, dims=8, neighbours=5)
    asked = np.concatenate([counts[:10], rng.random((20, quality.WIDTH)).astype(np.float32) * (rng.random((20, quality.WIDTH)) < 0.02), np.zeros((1, quality.WIDTH), np.float32)])
    got = votes.score(asked.copy(), block=7)
    for x, s in zip(asked, got):
        v = (x * votes.weight) @ votes.space
        v = v / max(np.linalg.norm(v), 1e-9)
        near = sorted(((float(v @ u), int(k)) for u, k in zip(votes.vectors, labels)), reverse=True)[:5]
        by = [max(c, 0.0) ** 8 for c, _ in near]
        assert abs(s - (sum(b * k for b, (_, k) in zip(by, near)) / sum(by) if sum(by) else 0.4)) < 1e-4


def test_one_id_on_many_rows_is_learned_once(spark):
    docs, labels = tiny(spark)
    many = docs.select("doc_id", "text").unionByName(spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text")))
    picked = quality.labelled_texts(many, quality.labelled_ids(labels, "quality", (50, 50), many))
    assert picked.count() == picked.select("doc_id").distinct().count() <= 100
    few = quality.labelled_ids(labels, "quality", (50, 50), docs.where("doc_id < 5"))
    assert 0 < few.count() <= 5
    named = quality.score(many.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")), labels.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")))
    assert named.count() == many.count()


TURNS = "conv_id long, turn long, role string, text string, window long"


def conversations():
    rnd = random.Random(4)
    nasty = ["### Assistant: </turn> ok", r"\### \\ </turn", "</turn>\n### user: hi</turn>\n", "", None, "###", "\\", "a: b", "\\h\\t\\c", "</tur" + "n>"]
    rows = [(n, t, rnd.choice(["user", "assistant", "system", None, "a: b\n", "###"]), rnd.choice(nasty)) for n in range(30) for t in range(rnd.randint(1, 6))]
    rows += [(100, t, "system" if t == 0 else ("user", "assistant")[t % 2], f"text {t} " + "word " * rnd.randint(0, 60)) for t in range(80)]
    rows += [(101, 0, "user", "long " * 3000), (101, 1, "assistant", "answer"), (102, 1, "user", "x"), (102, 1, "user", "x"), (102, None, "user", "y"), (None, 0, "assistant", "z")]
    return [(*r, 0) for r in rows]


def in_order(rows):
    low = lambda v: (v is not None, v)
    convs = defaultdict(list)
    for conv, turn, role, text, _ in rows:
        convs[conv].append((low(turn), role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(v)] for c, v in convs.items()}


@pytest.mark.parametrize("budget,history,tokenizer", [(2048, 256, None), (60, 20, "byte_bpe_50k.json"), (1, 0, None), (90, 80, "byte_bpe_50k.json")])
def test_chat_windows(spark, budget, history, tokenizer):
    path = tokenizer and P.path(tokenizer)
    lib = path and Tokenizer.from_file(path)
    rows = conversations()
    frame = spark.createDataFrame(rows, TURNS)
    windows = defaultdict(list)
    for w in chat.format_windows(frame, budget, history, path).collect():
        windows[w.conv_id].append(w)
    digests = {r.conv_id: r for r in chat.window_digests(frame, budget, history, path).collect()}
    for conv, turns in in_order(rows).items():
        said = [t for r, t in turns if r == "assistant"]
        d = digests[conv]
        assert d.n_turns == len(turns) and d.loss_chars == sum(map(len, said))
        assert d.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert d.loss_sha256 == hashlib.sha256("".join(said).encode()).hexdigest()
        own = sorted(windows[conv], key=lambda w: w.window)
        assert d.formatted_chars == sum(len(w.text) for w in own) and [w.window for w in own] == list(range(len(own)))
        back = []
        for n, w in enumerate(own):
            read = chat.parsed(w.text)
            cost = chat.counter(path)([chat.formatted(r, t) for r, t in read])
            assert sum(cost) <= budget or len(read) == 1
            if lib and len(read) > 1:
                assert len(lib.encode(w.text, add_special_tokens=False).ids) <= budget
            led = n > 0 and turns[0][0] == "system" and w.repeated > 0 and read[0] == turns[0]
            if n and turns[0][0] == "system" and not led:  # only a turn that leaves it no room is without the system turn
                assert w.repeated == 0 and sum(chat.counter(path)([chat.formatted(*turns[0]), chat.formatted(*read[0])])) > budget
            assert read[led : w.repeated] == back[len(back) - (w.repeated - led) :][: w.repeated - led]
            back += read[w.repeated :]
        assert back == turns
    assert len(digests) == len(in_order(rows))
    assert chat.window_digests(frame.limit(0)).count() == 0 and chat.format_windows(frame.limit(0)).count() == 0


PAGES = "page_id long, url string, html string, host string, template string, n int"


def test_url_filter(spark):
    rnd = random.Random(6)
    urls = [None, "", "no scheme", "http://", "://", "HTTP://WWW.Example.COM/en/x", "https://example.com", "https://example.com/en", "http://a.example.com/en/1?x=/fr/", "http://x.net/es/1", "http://x.net//es/1", "ftp://notexample.com/en/", "http://com/", "http://É.Net/FR/", "http://a/b/c/d/e/f/g", "x://y://z/q", "http://h\nh/p\np?q"]
    urls += [f"http://{rnd.choice(['www', 'blog', 'm'])}.{rnd.choice(['ab', 'cd'])}.{rnd.choice(['net', 'org', 'com'])}/{rnd.choice(['en', 'fr', 'es', 'tag'])}/{rnd.choice([rnd.randint(0, 999), 'word' + chr(97 + rnd.randint(0, 25)) * 3])}{rnd.choice(['', '/', '.html', '?a=1', '#top'])}" for _ in range(600)]
    rows = [(n, u, None, "h", "t", 1) for n, u in enumerate(urls)] + [(3, "http://x.net/fr/1", None, None, None, None)] * 2 + [(None, "http://q.org/", None, None, None, None)]
    pages = spark.createDataFrame(rows, PAGES)
    got = url_filter.judge(pages)
    con = duckdb.connect()
    con.register("frame", pages.toPandas())
    con.execute("CREATE VIEW pages AS SELECT page_id::BIGINT AS page_id, url FROM frame")
    assert compare(got, con, url_filter.sql()) is None
    by_id = {r.page_id: r for r in got.collect() if r.page_id is not None}
    assert (by_id[0].host, by_id[0].path, by_id[0].rule) == ("", "", None)
    assert (by_id[5].host, by_id[5].rule, by_id[5].verdict) == ("www.example.com", "www.example.com/en/", "allow")
    assert (by_id[6].path, by_id[6].rule, by_id[7].rule) == ("", None, "com/")
    assert (by_id[8].rule, by_id[9].verdict, by_id[11].rule) == ("example.com/en/", "block", "com/")
    assert all(r.verdict in ("allow", "block") for r in by_id.values())
    assert url_filter.judge(pages.limit(0)).count() == 0


def learned(rows, reject=0.5, apart=3.84):
    """Verdicts and templates of (host, path, ruled) by plain recursion."""
    def segments(path):
        return ["{n}" if any(c in "0123456789" for c in x) else x for x in path.split("/") if x]

    def grow(own, level, template):
        b, a = (sum(r[2] == v for r in own) for v in ("block", "allow"))
        if not (b + a and (len(own) > b + a or (b and a))):
            yield from ((r, template + "/**") for r in own)
            return
        kids, kinds = defaultdict(list), defaultdict(list)
        for r in own:
            s = segments(r[1])
            kids[s[level] if level < len(s) else ""].append(r)
        for s, rs in kids.items():
            kb, km = sum(r[2] == "block" for r in rs), sum(r[2] is not None for r in rs)
            gap = kb * (b + a) - b * km
            far = gap * gap > apart * b * a * km
            kinds["" if s == "" else "?" if not km else "+" if far and gap > 0 else "-" if far else "="].append(s)
        for kind, names in kinds.items():
            at = template + "/" + (names[0] if len(names) == 1 else kind)
            rs = [r for s in names for r in kids[s]]
            if kind == "":
                yield from ((r, at) for r in rs)
            else:
                yield from grow(rs, level + 1, at)

    out = {}
    for host in {r[1] for r in rows}:
        found = list(grow([(n, path, ruled) for n, h, path, ruled in rows if h == host], 0, ""))
        for t in {t for _, t in found}:
            own = [r for r, at in found if at == t]
            b, a = (sum(r[2] == v for r in own) for v in ("block", "allow"))
            out |= {r[0]: (t, r[2] or ("block" if (b + 1) / (b + a + 4) >= reject else "allow")) for r in own}
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_templates_equal_plain_recursion(spark, seed):
    rnd = random.Random(seed)
    words = ["a", "b", "c", "d1", "", "x", "en", "fr"]
    rules = (url_filter.Rule("block", "h.net", "/a/b/"), url_filter.Rule("allow", "h.net", "/a/"), url_filter.Rule("block", "h.net", "/fr"), url_filter.Rule("block", "k.org", "/x/x/x/x/x/x/x/en"), url_filter.Rule("allow", "k.org", "/x/7"))
    urls = ["http://" + rnd.choice(["h.net", "m.h.net", "k.org", "z.io"]) + "".join("/" + rnd.choice(words) for _ in range(rnd.randint(0, 4))) for _ in range(500)]
    urls += ["http://k.org" + "/x" * rnd.randint(0, 9) + rnd.choice(["", "/en", "/fr", "/7", "/8"]) for _ in range(200)]
    got = url_filter.judge(spark.createDataFrame([(n, u, None, None, None, 0) for n, u in enumerate(urls)], PAGES), rules).collect()
    verdicts = {r.name: r.verdict for r in rules}
    want = learned([(r.page_id, r.host, r.path, verdicts.get(r.rule)) for r in got])
    assert {r.page_id: (r.template, r.verdict) for r in got} == want and len(got) == len(urls)


def test_no_page_is_blocked_without_labels_of_its_own(spark):
    few = ["about", "contact", "de", "jobs", "legal", "press", "shop", "team", *[f"page-{chr(97 + n)}" for n in range(20)]]
    first = ["fr"] * 30 + ["es"] * 25 + ["home"] * 300 + [few[n % len(few)] for n in range(645)]
    urls = [f"http://big.net/{s}/x{n}" for n, s in enumerate(first)] + [f"http://big.net//fr/y{n}" for n in range(3)]
    urls += [f"http://www.example.com/{s}/z{n}" for n, s in enumerate(["en"] * 10 + few * 10)] + [f"http://m.example.com/{s}/z" for s in ["en"] * 10 + few * 10]
    # a common segment without labels beside a few blocked ones
    urls += [f"http://small.net/{s}/1" for s in ["fr", "es", "fr"] + ["en"] * 20 + ["de"] * 3]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame([(n, u, None, None, None, 0) for n, u in enumerate(urls)], PAGES)).collect()}
    assert len(got) == len(urls)
    for n, s in enumerate(first):
        assert got[n].verdict == ("block" if s in ("fr", "es") else "allow"), urls[n]
    assert all(got[n].rule is None and got[n].verdict == "block" for n in range(1000, 1003))  # the same segments as the blocked ones
    assert all((r.verdict == "block") == r.path.startswith("/en/") for r in got.values() if r.host == "m.example.com")
    assert all((r.verdict == "block") == r.path.startswith(("/fr/", "/es/")) for r in got.values() if r.host == "small.net")


def brute(rows, k, every, scale):
    sound = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in sound if i % every == 0}):
        v = [v for i, v in sound if i == q][0]
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in sound if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return out


@pytest.mark.parametrize("limits", [{}, {"block": 40, "query_block": 3}, {"block": 7, "query_block": 1, "most_pivots": 4}])
def test_top_k(spark, limits):
    rnd = random.Random(8)
    rows = [(n, [rnd.gauss(0, 0.3) + (n % 3) for _ in range(6)], "x") for n in range(300)]
    rows += [(1000 + n, [0.5, -0.25, 0.125, 1.0, -1.0, 0.0], "same") for n in range(120)]
    rows += [(2000, None, None), (2001, [None] * 6, None), (2100, [float("nan")] * 6, None), (2200, [1.0, float("inf")], None), (None, [1.0] * 6, None), (2300, [2.0, 1.0], "short"), (2301, [], "none"), (7, [9.0] * 6, "again"), (7, [9.0] * 6, "again")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, raw string")
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v, _ in rows]
    got = topk.exact_top_k(vectors, 10, 20, 1024, **limits)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute(single, 10, 20, 1024))
    few = topk.exact_top_k(vectors.where("vec_id in (0, 1, 2)"), 10, 20, 1024, **limits)
    assert few.count() == 2 and topk.exact_top_k(vectors.limit(0)).count() == 0


def test_top_k_beyond_doubles(spark):
    rnd = random.Random(9)
    rows = [(n, [rnd.choice([300_000.0, 3e5 + 1, -3e5]), *(rnd.randint(-5, 5) / 1024 for _ in range(3))], "x") for n in range(120)]
    rows += [(n, [2.0**20, rnd.randint(-3, 3) / 1024, 0.0, 0.0], "x") for n in range(200, 260)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, raw string")
    got = topk.exact_top_k(vectors, 10, 20, 1024, block=50)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute([(i, v) for i, v, _ in rows], 10, 20, 1024))
    with pytest.raises(Exception, match="64 bits"):
        topk.exact_top_k(spark.createDataFrame([(0, [2.0**40], "x"), (1, [2.0**40], "x")], "vec_id long, embedding array<double>, raw string")).collect()


def test_cover_tree_radii_cover(spark):
    points = np.random.default_rng(1).integers(-50, 50, (900, 5)).astype(float)
    tree = topk.CoverTree(points)
    for c, r, rows, kids in zip(tree.centre, tree.radius, tree.rows, tree.children):
        assert np.sqrt(((points[rows] - points[c]) ** 2).sum(1)).max() <= r + 1e-9
        assert not kids or sorted(np.concatenate([tree.rows[k] for k in kids])) == sorted(rows)


def test_pipeline_stage_by_stage(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    by_hand = docs.collect()

    def left(column_scores, wanted):
        rejected = {r.doc_id for r in column_scores.collect() if r.predicted != wanted}
        return [r for r in by_hand if r.doc_id not in rejected]

    by_hand = left(quality.score(docs, labels), 1)
    by_hand = left(toxicity.score(spark.createDataFrame(by_hand, docs.schema), labels), 0)
    best = {}
    for r in by_hand:
        key = "".join((r.text or "").split())
        best[key] = min(best.get(key, (1, 0, None)), (-len(r.text or ""), r.doc_id, r), key=lambda x: x[:2])
    by_hand = [r for _, _, r in best.values()]
    code = {r.doc_id: simhash.fingerprint(r.text) for r in by_hand}
    from tests.llm.test_text_operators import brute_components

    root = brute_components(set(code.values()), 4)
    first = {}
    for doc, c in sorted(code.items()):
        first.setdefault(root[c], doc)
    want = {first[root[c]] for c in code.values()}
    got = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in got.select("doc_id").collect()} == want
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "toxicity", "exact dedup", "SimHash near-dedup", "packing"]


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_and_empty_documents(spark, stage):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(0, None, None, None, None), (1, "", "", "", 0), (1, "", "", "", 0), (None, "text", None, None, None), (2, "w " * 30_000, "en", "s", 60_000), (3, "same", None, None, None), (4, "same", None, None, None)]
    frame = spark.createDataFrame(rows, schema)
    out = stage(spark, frame, SF)
    if stage is not corpus_pipeline.packed:
        assert out.columns == frame.columns
    assert out.count() > 0 and stage(spark, frame.limit(0), SF).count() == 0
