"""Corpus operators against brute force, on small rows with every odd case."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridtally.llm import decontaminate, embeddings, html_text, language, mixing, repeats, secrets, sharding, token_counts
from gridtally.llm.components import components
from gridtally.llm.embeddings import near_duplicates
from gridtally.llm.jaccard import similar
from gridtally.llm.words import words
from gridtally.session import written_once

SYLLABLES = "ta re mi so lan dor vek hun pil".split()
ENDINGS = "a e i o u ast ent".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard string, kept int, tokens double"


def made(n: int, seed: int) -> str:
    """Words of two or three syllables in one."""
    chooser = random.Random(seed)
    return " ".join(
        "".join(chooser.choice(SYLLABLES) for _ in range(chooser.randint(1, 2))) + chooser.choice(ENDINGS) for _ in range(n)
    )


BASE = made(300, 1)
NEAR = BASE.replace(" ", "  ", 5).rsplit(" ", 20)[0] + " something quite new here"
TEXTS = [
    (1, BASE),
    (2, BASE.upper()),
    (3, NEAR),
    (4, None),
    (5, ""),
    (6, "!!! ..."),
    (7, "one two"),
    (8, "One, two!"),
    (9, made(20_000, 2)),
    (10, made(200, 3) + " " + BASE[:500] + " " + made(100, 4)),
    (11, "ä" * 900),
    (12, made(60, 5)),
    (12, made(60, 5)),
    (None, BASE),
    (13, "x" + made(200, 3)),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", None if i == 7 else "s", len(t or ""), "clash", 1, 0.5) for i, t in TEXTS]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def test_empty_tables(spark, nothing):
    bench = spark.createDataFrame([], "item_id long, text string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    made_from = [
        secrets.op1_secret_scan(nothing), sharding.op2_byte_shards(nothing), html_text.op3_main_text(pages),
        near_duplicates(vectors), language.op5_language_id(nothing), mixing.op6_mixed_sample(nothing), similar(nothing),
        repeats.op8_repeated_bytes(nothing), token_counts.op9_section_tokens(nothing), decontaminate.leaks(nothing, bench),
    ]
    assert [df.count() for df in made_from] == [0] * 10


def test_secrets(spark):
    chooser = random.Random(5)
    key = "".join(chooser.choice("ABCDEFGHabcdefghijkl0123456789+/xyzXYZ") for _ in range(44))
    texts = [
        'PassWord = "hunter22" and token: abc', "secret=token:abcdefgh ſecret=abcdefgh", "AKIA" + "Q7" * 8 + " AKIAQ7", "f" * 24 + "g" + "0" * 23,
        None, "", f"here {key} ends", "an_ordinary_identifier_of_a_program " * 300 + "tareaMisoentLandoraVekastHunpilo", "api_key:" + "d" * 30,
    ]
    # Samples to learn from: values that a pattern finds, and ordinary names.
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    values = ["token: " + "".join(chooser.choice(letters) for _ in range(40)) for _ in range(300)]
    names = [chooser.choice(letters[:26]) + w + str(n % 10) * (n % 3) for n, w in enumerate(made(30_000, 9).split())]
    humps = [a + b.title() + c.title() for a, b, c in zip(*[iter(made(9000, 12).split())] * 3)]
    texts += [" ".join(values), " ".join(names), "_".join(names[:9000]) + " " + " ".join(humps)]
    rows = secrets.op1_secret_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {r.doc_id: r for r in rows}
    assign = r"""((?i:password|passwd|secret|token)|(?i:api)_?(?i:key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for i, text in enumerate(t or "" for t in texts):
        spans = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6 and m[1].isascii()]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        base = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest(), text
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(k == n for _, k, _ in spans) for n in range(3))
    assert f"markov:5:{5 + len(key)}" in got[6].spans
    assert [got[i].n_markov for i in (7, 10, 11)] == [0, 0, 0] and got[4].spans == ""


def test_shards(docs):
    rows = sharding.op2_byte_shards(docs, 4).orderBy("shard", "slot").collect()
    texts = {i: t or "" for i, t in TEXTS}
    assert len(rows) == len(TEXTS) and {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    for r in rows:
        assert r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r)
    assert all([r.slot for r in rs] == list(range(len(rs))) for rs in by_shard.values())
    ids = [r.doc_id if r.doc_id is not None else -1 for r in rows]
    assert ids == sorted(ids)
    # The middle of each byte interval lies in its shard.
    total, at = sum(r.size for r in rows), 0
    for r in rows:
        assert r.shard == (2 * at + r.size) * 4 // (2 * total)
        at += r.size


def test_main_text(spark):
    side = "<div class='box'><a href='/x'>Read  more</a></div>"
    pages = [(i, f"https://a.org/{i}", f"<body>{side}<div><p>Own &amp; text&nbsp;{i}</div>tail {i}</body>") for i in range(6)]
    pages += [
        (10, "https://b.org/1", side + "<p>kept</p>"),
        (11, None, None),
        (12, "x", ""),
        (13, "https://b.org/2", "<nav>m</nav><div>no</div><article><h1>T</h1><p><b>A <i>b</i><br>c<p>d<ul><li>e<li>f</ul>"
         "<div class='comments'>rude</div><script>if (a<b) '</p>'</script><!-- x --><form>q</form></article><footer>z</footer>"),
        (14, "https://b.org/3", '<main><p data-x="a>b">1 &lt; 2</p><aside>s</aside><div id="cookie-note">c</div>end</main>'),
        (14, "https://b.org/3", '<main><p data-x="a>b">1 &lt; 2</p><aside>s</aside><div id="cookie-note">c</div>end</main>'),
    ]
    frame = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, text string")
    rows = html_text.op3_main_text(frame).collect()
    got = {r.page_id: r.text for r in rows}
    assert len(rows) == len(pages) and all(r.n_chars == len(r.text) for r in rows)
    assert [got[i] for i in range(6)] == [f"Own & text {i}\ntail {i}" for i in range(6)]
    assert (got[10], got[11], got[12]) == ("Read more\nkept", "", "")
    assert got[13] == "T\nA b c\nd\ne\nf" and got[14] == "1 < 2\nend"


def test_main_text_keeps_copied_articles(spark):
    """Copies on a large host, unmarked or wrapped inside of an article, are no template; what most pages hold is."""
    side, copy = "<div class='box'>Read more</div>", "<div><p>Copied</p><ul><li>text</li></ul></div>"
    bodies = [f"{side}<div><p>Own {i}</p></div>{copy if i < 8 else ''}" for i in range(40)]
    pages = [(i, f"https://l.org/{i}", f"<body>{b}</body>") for i, b in enumerate(bodies)]
    pages += [(100 + i, f"https://m.org/{i}", f"<body><article><h1>T{i}</h1>{copy}<table><tr><td>x</table></article></body>") for i in range(6)]
    got = {r.page_id: r.text for r in html_text.op3_main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(40)] == [f"Own {i}" + "\nCopied\ntext" * (i < 8) for i in range(40)]
    assert [got[100 + i] for i in range(6)] == [f"T{i}\nCopied\ntext\nx" for i in range(6)]


def test_vectors(spark):
    chooser = np.random.default_rng(4)
    points = []
    for _ in range(40):
        middle = chooser.normal(size=16)
        points += [(middle + chooser.normal(size=16) * s).tolist() for s in (0, 0.2, 0.35, 0.5)]
    points += [points[0], points[0], [0.0] * 16, None, [float("nan")] * 16, [1.0] * 3, [None] * 16, [2 * x for x in points[4]]]
    frame = spark.createDataFrame([(i, p, 0) for i, p in enumerate(points)] + [(None, points[0], 0)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in near_duplicates(frame).collect()}
    good = [i for i, p in enumerate(points) if p and len(p) == 16 and all(x is not None and math.isfinite(x) for x in p) and any(p)]
    unit = {i: np.array(points[i]) / np.linalg.norm(points[i]) for i in good}
    near = {i: {j for j in good if j != i and unit[i] @ unit[j] >= 0.9} for i in good}
    for i in range(len(points)):
        seen, todo = {i}, [i]
        while todo:
            new = near.get(todo.pop(), set()) - seen
            seen |= new
            todo += new
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (len(near.get(i, ())), min(seen), min(seen) == i)
    assert got[None].n_links == 0 and got[None].component_id is None


def test_vectors_of_many_lists(spark, monkeypatch):
    """Links between lists that are far apart, with a sample that is a small part of the table."""
    monkeypatch.setattr(embeddings, "SAMPLE", 250)
    points = np.random.default_rng(6).normal(size=(5000, 8))
    frame = spark.createDataFrame(list(enumerate(points.tolist())), "vec_id long, embedding array<double>")
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    expect = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in near_duplicates(frame).collect()}
    assert [got[i] for i in range(len(points))] == expect.tolist()


@pytest.mark.parametrize("block", [4096, 100])
def test_vectors_in_random_lists(spark, monkeypatch, block):
    """Random lists find the links that all pairs have: at all angles, in a large group of near copies, of equal vectors."""
    monkeypatch.setattr(embeddings, "PROBED", 1e9)
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "AT_ONCE", 64)
    chooser = np.random.default_rng(8)
    middle = chooser.normal(size=(300, 24))
    points = [middle + chooser.normal(size=middle.shape) * s for s in (0, 0.2, 0.3, 0.35, 0.5)]
    points = np.concatenate([*points, middle[0] + chooser.normal(size=(400, 24)) * 0.1, middle[:5], 3 * middle[:5]])
    chosen = []
    choose = embeddings.chosen_directions
    monkeypatch.setattr(embeddings, "chosen_directions", lambda *given: chosen.append(choose(*given)) or chosen[-1])
    frame = spark.createDataFrame(list(enumerate(points.tolist())), "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in near_duplicates(frame).collect()}
    assert chosen[0] is not None
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    i, j = np.nonzero(unit @ unit.T >= 0.9)
    root = dict(zip(*(x.tolist() for x in embeddings.forest(i[i != j], j[i != j]))))
    assert [got[k].n_links for k in range(len(points))] == (np.bincount(i) - 1).tolist()
    assert [got[k].component_id for k in range(len(points))] == [root.get(k, k) for k in range(len(points))]


def test_work_on_vectors_without_groups(monkeypatch):
    """Ten times the vectors meet about as many in their lists; without a chance of a miss the bound alone is used."""
    points = np.random.default_rng(9).normal(size=(2000, 64))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    index = embeddings.fit(points, 16)
    met = []
    for number in (100_000, 1_000_000):
        turns, factors, size, _ = embeddings.chosen_directions(index, points, number, 0.9).shape
        assert (1 - embeddings.share(size, 0.9) ** factors) ** turns <= embeddings.MISS
        met.append(turns * number / size**factors)
    assert met[0] < 0.6 * 100_000 and met[1] < 4 * met[0]
    monkeypatch.setattr(embeddings, "MISS", 0)
    assert embeddings.chosen_directions(index, points, 1_000_000, 0.9) is None


@pytest.mark.parametrize("size", [2, 8, 64])
def test_share_of_random_lists(size):
    """No more than the share of random codes in which two vectors at that cosine meet, and not much less."""
    directions = np.random.default_rng(size).normal(size=(20_000, 1, size, 3)).astype(np.float32)
    one, other = embeddings.random_lists(directions, np.array([[1, 0, 0], [0.9, math.sqrt(0.19), 0]]))
    assert -0.01 < (one == other).mean() - embeddings.share(size, 0.9) < 0.03


def test_forward_backward_is_exact():
    chooser = np.random.default_rng(2)
    score, passing = chooser.normal(size=(7, 3)), chooser.normal(size=(3, 3))
    starts = np.array([1, 0, 0, 0, 1, 0, 0], bool)
    weight = defaultdict(float)
    for path in itertools.product(range(3), repeat=7):
        total = sum(score[t, k] for t, k in enumerate(path)) + sum(passing[path[t - 1], path[t]] for t in range(7) if not starts[t])
        for t, k in enumerate(path):
            weight[t, k] += math.exp(total)
    brute = np.array([[weight[t, k] for k in range(3)] for t in range(7)])
    assert np.allclose(language.marginals(score, starts, passing), brute / brute.sum(axis=1, keepdims=True))


def test_language(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(-1, None), (-2, "12 34 ..."), (None, "")], "doc_id long, text string")
    frame = docs.unionByName(odd, allowMissingColumns=True)
    rows = language.op5_language_id(frame).join(docs.select("doc_id", "lang"), "doc_id", "left").collect()
    assert len(rows) == frame.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in rows if r.doc_id is None or r.doc_id < 0} == {"und"}
    for r in rows:
        assert r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 4 == 2)
    held = [r.lang == r.lang_pred for r in rows if r.held_out and r.lang]
    assert sum(held) / len(held) > 0.9


def test_language_sample_is_filled(spark):
    """Null, empty, wordless and long texts leave no language without texts to learn from."""
    rows = [(i, made(20, i) if i % 3 == 0 else [None, "", "12 ..."][i % 2 + (i % 5 == 0)], "aa") for i in range(600)]
    rows += [(1000 + i, made(900, i), "bb") for i in range(40)]
    rows += [(2000 + i, made(900, i) if i % 2 else made(30, i), "cc") for i in range(40)] + [(3000, "x" * 9000, "dd")]
    rows += [(4000, "one two", "ee")] * 9 + [(4001, "three", "ee"), (4002, "four", "ee"), (4003, "five", "ee")]
    texts = {i: t for i, t, _ in rows}
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.sample(frame, 12, 1000).collect()
    count = Counter(r.lang for r in got)
    assert (count["aa"], count["bb"], count["cc"], count["dd"]) == (12, 12, 12, 0)
    for r in got:
        full = texts[r.doc_id]
        assert r.text == full if len(full) <= 1000 else full.startswith(r.text) and 900 < len(r.text) <= 1000
        assert set(r.text.split()) <= set(full.split()) and re.search("[a-z]", r.text)
        assert r.lang != "cc" or len(full) <= 1000
    assert count["ee"] == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(4000, 4004))


def test_language_chains_add_up(monkeypatch):
    texts, labels = [made(300, 1), made(300, 2).upper().replace("A", "å"), made(50, 3)], ["x", "y", "x"]
    whole = language.fit(texts, labels, steps=3)
    monkeypatch.setattr(language, "CHAIN", 100)
    parts = language.fit(texts, labels, steps=3)
    score = [language.emissions(m.weights, language.features(words(texts))) for m in (whole, parts)]
    assert (score[0].argmax(axis=1) == score[1].argmax(axis=1)).mean() > 0.98


def test_mixing(spark, docs):
    rows = [(i, "ab"[i % 5 > 3], ["x", "y", None][i % 3], ["p", "q"][i % 7 > 4], 10 + i % 9) for i in range(4000)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, topic string, tokens long").fillna("unknown")
    share = {"source": {"a": 0.5, "b": 0.5}, "lang": {"x": 0.2, "y": 0.4, "unknown": 0.4}, "topic": {"p": 0.5, "q": 0.5}}
    targets = {k: spark.createDataFrame(list(v.items()), f"{k} string, share double") for k, v in share.items()}
    got = mixing.mixed_sample(frame, targets, fraction=0.1, rounds=20).collect()
    expected = sum(r.prob * r.tokens for r in got)
    assert expected == pytest.approx(0.1 * sum(r.tokens for r in got), rel=1e-6)
    for name, wanted in share.items():
        for value, part in wanted.items():
            assert sum(r.prob * r.tokens for r in got if r[name] == value) == pytest.approx(part * expected, rel=1e-3)
    assert sum(r.sampled for r in got) == pytest.approx(sum(r.prob for r in got), rel=0.15)
    assert mixing.op6_mixed_sample(docs).count() == len(TEXTS)


def test_raking_meets_margins(spark):
    """Margins that hang together need many rounds; targets of absent values; null margins; margins that cannot be met."""
    cells = [("a", "x", 9000), ("a", "y", 30), ("b", "x", 20), ("b", "y", 50), ("b", None, 4)]
    frame = spark.createDataFrame(cells, "source string, lang string, tokens long")
    share = {"source": {"a": 0.3, "b": 0.7, "absent": 5.0}, "lang": {"x": 0.25, "y": 0.7, "unknown": 0.05}}
    targets = {k: spark.createDataFrame(list(v.items()), f"{k} string, share double") for k, v in share.items()}
    cells = mixing.raked(frame.fillna("unknown"), targets).collect()
    for name, wanted in share.items():
        for value in {c[name] for c in cells}:
            part = sum(c.weight for c in cells if c[name] == value)
            assert part == pytest.approx(wanted[value], abs=3 * mixing.TOLERANCE)
    keyed = frame.selectExpr("monotonically_increasing_id() as doc_id", "*", "'z' as prob", "2 as weight")
    got = mixing.mixed_sample(keyed.drop("prob", "weight"), targets, 0.01).collect()
    assert len(got) == 5 and {r.lang for r in got} == {"x", "y", "unknown"}
    apart = spark.createDataFrame([("a", "x", 5), ("b", "y", 5)], "source string, lang string, tokens long")
    with pytest.warns(UserWarning, match="margins"):
        assert mixing.raked(apart, {k: v for k, v in targets.items()}, rounds=3).count() == 2


def shingle_set(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def test_jaccard(spark, docs):
    many = [(100 + i, BASE.replace(" ", f" x{i} ", 1)) for i in range(300)]
    frame = docs.select("doc_id", "text", "kept").unionByName(spark.createDataFrame(many, "doc_id long, text string"), allowMissingColumns=True)
    given = TEXTS + many
    sets = [shingle_set(t) if i is not None else frozenset() for i, t in given]
    near = {
        a: {b for b, y in enumerate(sets) if a != b and x and y and len(x & y) >= 0.8 * len(x | y)} for a, x in enumerate(sets)
    }
    expect = []
    for a, (i, _) in enumerate(given):
        seen, todo = {a}, [a]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        expect.append((i, min((given[b][0] for b in seen), key=lambda x: -1 if x is None else x), len(near[a])))
    got = [tuple(r) for r in similar(frame).collect()]
    assert sorted(got, key=repr) == sorted(expect, key=repr)


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(50, 40), (40, 45), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 40: 40, 45: 40, 50: 40}


@pytest.mark.parametrize("together", [4096, 1])
def test_repeated_bytes(docs, monkeypatch, together):
    monkeypatch.setattr(repeats, "TOGETHER", together)
    texts = [(t or "").encode() for _, t in TEXTS]
    count = Counter(b[p : p + 400] for b in texts for p in range(len(b) - 399))
    expect = []
    for (i, _), b in zip(TEXTS, texts):
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - 399):
            if count[b[p : p + 400]] > 1:
                gone[p : p + 400] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        runs = int((gone[:-1] & ~np.concatenate(([False], gone[:-2]))).sum()) if b else 0
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone[:-1].astype(int), [0])))).tolist()
        removed = ",".join(f"{begin}:{end}" for begin, end in zip(edges[::2], edges[1::2]))
        shown = kept.decode("utf-8", "replace")
        expect.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), shown, removed))
    got = [tuple(r) for r in repeats.op8_repeated_bytes(docs).collect()]
    assert sorted(got, key=repr) == sorted(expect, key=repr)


def test_frequent_bucket_is_not_held_in_one_task(spark, monkeypatch):
    passage = made(60, 50)[:340]
    rows = [(i, f"{made(40, 100 + i)} {passage} {made(40, 200 + i)}") for i in range(40)]
    rows += [(100 + i, "y" + rows[i][1][:500] + "z" * i) for i in range(3)]
    plans = []

    def written(frame, label):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return written_once(frame, label)

    monkeypatch.setattr(repeats, "written_once", written)
    monkeypatch.setattr(repeats, "TOGETHER", 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keyed = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "xxhash64(text) text_key", "text")
        found = repeats.repeats(keyed)
        by_bucket = re.compile(r"SortMergeJoin \[bucket#\d+L\]")
        # Spark splits a large key of this join only where no side is aggregated on the way.
        assert all("Aggregate" not in plan for plan in plans if by_bucket.search(plan))
        assert sum(bool(by_bucket.search(plan)) for plan in plans) == 1
        assert not by_bucket.search(found._jdf.queryExecution().executedPlan().toString())
        got = {(r.doc_id, p) for r in found.collect() for p in range(r.start, r.stop)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    count = Counter(t[p : p + 400] for _, t in rows for p in range(len(t) - 399))
    starts = [(i, p) for i, t in rows for p in range(len(t) - 399) if count[t[p : p + 400]] > 1]
    assert got == {(i, q) for i, p in starts for q in range(p, p + 400)} and starts


def test_token_counts(spark):
    texts = [None, "", "one line", "a\n\nbb  cc\n ddd\n", "\n\n", "naïve\n\t\tç'est   \n  x", made(50, 1) + "\n" + made(9, 2)]
    frame = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, section string")
    got = defaultdict(list)
    for r in token_counts.op9_section_tokens(frame).collect():
        got[r.doc_id].append(r)
    with open(token_counts.VOCABULARY, "rb") as file:
        encoder, _ = token_counts._encoder(file.read(), token_counts.PATTERN)
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        pieces = encoder.decode_tokens_bytes(encoder.encode_ordinary(text or ""))
        line_of, spans, at = {}, [], 0
        for line in raw.split(b"\n"):
            if line:
                line_of.update(dict.fromkeys(range(at, at + len(line)), len(spans)))
                spans.append((at, at + len(line)))
            at += len(line) + 1
        expect, at = Counter(), 0
        for piece in pieces:
            held = Counter(line_of[p] for p in range(at, at + len(piece)) if p in line_of)
            expect[min(held, key=lambda s: (-held[s], s)) if held else -1] += 1
            at += len(piece)
        rows = {r.section: r for r in got[i]}
        assert {s: r.n_tokens for s, r in rows.items() if r.n_tokens} == dict(expect)
        assert sum(r.n_tokens for r in got[i]) == len(pieces) == got[i][0].doc_tokens
        assert [(rows[s].byte_start, rows[s].byte_end) for s in range(len(spans))] == spans


def test_leaks(spark):
    items = [(i, made(30 + i, 100 + i)) for i in range(40)] + [(50, made(150, 70)), (51, None), (52, ""), (53, "tiny item")]
    docs = [(i, made(500, 200 + i)) for i in range(20)] + [(90, None), (91, "")]
    docs += [(30, made(300, 7) + " " + items[3][1].upper().replace(" ", ", ") + " " + made(300, 8)), (31, items[40][1]), (None, items[5][1])]
    docs += [(32, made(100, 9) + " " + " ".join(items[6][1].split()[:12]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(30, 3), (31, 50), (None, 5)}


def test_leaks_of_long_items(spark):
    """Verbatim copies at every offset of the stride."""
    items = [(n, made(n, 900 + n)) for n in (300, 450, 2000)]
    docs = [(n * 1000 + k, " ".join([made(70 + k, k), text, made(90, 3000 + k)])) for n, text in items for k in range(decontaminate.STEP)]
    halves = [(-n, made(100, n) + " " + " ".join(text.split()[: n // 2]) + " " + made(n, n + 1)) for n, text in items]
    frame = spark.createDataFrame(docs + halves, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(i, i // 1000) for i, _ in docs}


def test_leaks_do_not_depend_on_shards(spark, monkeypatch):
    """Equal and repeated items, an id of two texts, clashing columns; words that are common in one shard only."""
    items = [(i, made(30 + i % 90, 100 + i % 50)) for i in range(120)] + [(5, made(40, 999)), (None, made(30, 100)), (7, None)]
    docs = [(i, made(60, 500 + i) + " " + items[i % 123][1] + " " + made(60, 700 + i)) for i in range(120)]
    docs += [(200 + i, " ".join(items[i][1].split()[: 18 + i % 30])) for i in range(60)] + [(3, items[9][1]), (3, items[9][1]), (5, items[120][1])]
    docs = [(i, text, "x", 1, 2.0) for i, text in docs]
    frame = spark.createDataFrame(docs, "doc_id long, text string, item string, shard int, score double")
    bench = spark.createDataFrame([(*x, "y", 3) for x in items], "item_id long, text string, item string, doc_id int")

    def found():
        return sorted(decontaminate.leaks(frame, bench).collect(), key=repr)

    whole = found()
    assert len(whole) > 200 and {(3, 9), (0, 0), (0, None), (5, 5)} <= {(r.doc_id, r.item_id) for r in whole}
    assert len(whole) == len({(r.doc_id, r.item_id) for r in whole})
    monkeypatch.setattr(decontaminate, "MAX_ENTRIES", 16)
    assert found() == whole


def test_bounds_lose_no_entry():
    items = [(i, made(25 + i % 20, i)) for i in range(90)]
    index = decontaminate.build_index(items)
    found = words([made(150, 500 + i) + " " + items[i][1][: 60 + 3 * i] for i in range(60)])
    begin, end, _ = decontaminate.passages(found.first)
    term = decontaminate.terms_of(index, found.digest)
    got = {(p, e): s for p, e, s in decontaminate.retrieve(index, term, begin, end)}
    brute = {}
    for p, (a, b) in enumerate(zip(begin, end)):
        have = set(term[a:b].tolist())
        for e, weights in enumerate(index.full):
            score = sum(w for t, w in weights.items() if t in have)
            if score >= decontaminate.THRESHOLD:
                brute[p, e] = score
    assert brute and got.keys() == brute.keys() and all(got[k] == pytest.approx(brute[k]) for k in brute)


def test_pipeline_stages(spark, sf_dir, docs, nothing):
    import corpus_pipeline as P

    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    kept = {}
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in P.STAGES:
        frame = P.written_once(stage(spark, frame, sf_dir), name)
        kept[name] = {r.doc_id for r in frame.select("doc_id").collect()}
        assert name == "sharding" or frame.columns == columns
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert kept["language"] == {i for i, t in texts.items() if re.search(r"[^\W\d_]", t)}
    sets = {i: shingle_set(texts[i]) for i in kept["language"]}
    root = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
    assert kept["near_duplicates"] == set(root.values())
    plain = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    items = [plain(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert kept["decontamination"] == {i for i in kept["near_duplicates"] if not any(x in plain(texts[i]) for x in items)}
    assert kept["sharding"] == kept["mixing"] < kept["decontamination"]
    for _, stage in P.STAGES:
        assert stage(spark, nothing, sf_dir).count() == 0
    odd = P.near_duplicates(spark, docs, sf_dir)
    assert odd.columns == docs.columns
    assert sorted((r.doc_id for r in odd.collect()), key=repr) == sorted([1, 4, 5, 6, 7, 9, 10, 11, 12, None, 13], key=repr)
