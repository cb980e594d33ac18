"""Operators against brute force on small tables that hold nulls, empty and long texts, ties and repeated rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmark.llm import bpe, exact, html, language, lines, multiset, near, packing, quality, substring

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, h long, row int, score double"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi pi rho".split()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    passage, line = prose(rng, 60), "A line that is Common to many"
    out = [None, "", "   ", "\n\n", "Ab", "aB", "é", "É ß", prose(rng, 30000)]
    base = prose(rng, 120).split()
    for i in range(12):
        near_copy = list(base)
        near_copy[rng.randrange(120)] = f"changed{i}"
        out += [" ".join(near_copy), prose(rng, 20) + " " + passage + " " + prose(rng, 5),
                f"{prose(rng, 4)}\n  {line.upper()}\t\n{line}\n{prose(rng, 6)}", prose(rng, rng.randint(1, 40))]
    out += [out[9], out[9].upper(), out[10], " ".join(base), "loop this " * 40, "loop this " * 50]
    return [(i * 3 % 67, t) for i, t in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0, False, 1, 2, 0.5) for i, t in texts], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_substring(docs, texts, empty):
    words = {i: (t or "").split() for i, t in texts}
    first = {}
    for i in sorted(words):
        for p in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][p:p + 13]), i)
    want = {}
    for i, own in words.items():
        gone = {q for p in range(len(own) - 12) if first[tuple(own[p:p + 13])] < i for q in range(p, p + 13)}
        want[i] = (len(own), len(gone), " ".join(w for q, w in enumerate(own) if q not in gone))
    spans = substring.duplicate_spans(docs)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in substring.without_spans(docs, spans).collect()}
    assert got == want
    assert any(n for _, n, _ in want.values())
    for r in spans.collect():
        for start, length, origin in zip(r["starts"], r["lengths"], r["sources"]):
            assert length >= 13 and origin < r["doc_id"] and start + length <= len(words[r["doc_id"]])
    cut = substring.cut(docs, substring.duplicate_spans(docs, whole_rows=True))
    assert cut.columns == docs.columns
    given = dict(texts)
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == {
        i: kept if n else given[i] for i, (k, n, kept) in want.items() if not n or n < k}
    assert substring.without_spans(empty, substring.duplicate_spans(empty)).count() == 0


def test_substring_repeated_ids(spark):
    passage = prose(random.Random(3), 20)
    rows = [(1, passage), (1, "x " + passage), (2, passage + " y"), (2, passage), (None, passage), (None, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"]) for r in
                  substring.without_spans(df, substring.duplicate_spans(df)).collect())
    # the null id comes first; rows of one id do not repeat one another
    assert got == Counter([(None, 20, 0), (None, 1, 0), (1, 20, 20), (1, 21, 20), (2, 21, 20), (2, 20, 20)])


def test_greedy_parse():
    import numpy as np
    at, source = np.array([5, 6, 7, 20, 21, 22]), np.array([1, 1, 2, 3, 3, 3])
    assert [x.tolist() for x in substring.parse(at, source, 13)] == [[5, 7, 20], [14, 13, 15], [1, 2, 3]]


def test_lines(spark, docs, texts, empty):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\r\x0b\x0c"))
    first = {}
    for i, t in sorted(texts, key=lambda x: x[0]):
        for x in (t or "").split("\n"):
            first.setdefault(key(x), i)
    want = {}
    for i, t in texts:
        own = (t or "").split("\n")
        kept = [x for x in own if len(key(x)) < 10 or first[key(x)] == i]
        want[i] = (len(own), len(own) - len(kept), "\n".join(kept))
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"])
           for r in lines.kept_lines(docs, lines.line_bitmaps(docs, partitions=9)).collect()}
    assert got == want
    assert any(d for _, d, _ in want.values())
    assert lines.kept_lines(empty, lines.line_bitmaps(empty)).count() == 0
    many = spark.createDataFrame([(i, "one very common line\nown line number %d" % i) for i in range(400)], "doc_id long, text string")
    assert lines.line_bitmaps(many, partitions=7).agg(F.sum("n_dropped")).first()[0] == 399


def test_exact(spark, docs, texts, empty, monkeypatch):
    low = [(i, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) for i, t in texts]
    groups = defaultdict(list)
    for i, t in low:
        groups[t].append(i)
    want = {i: (max(groups[t]), len(groups[t]), i == max(groups[t]), sha(t)) for i, t in low}

    def got(df):
        return {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact.exact_duplicates(df).collect()}
    assert got(docs) == want
    monkeypatch.setattr(exact, "VERIFY_ROWS", 1)
    assert got(docs) == want
    assert exact.exact_duplicates(empty).count() == 0
    same = spark.createDataFrame([(None, "x"), (1, "X"), (1, "x"), (0, "y")], "doc_id long, text string")
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact.exact_duplicates(same).collect()) == Counter(
        [(None, 1, 3, False), (1, 1, 3, True), (1, 1, 3, True), (0, 0, 1, True)])


def test_exact_settles_colliding_fingerprints(spark, monkeypatch):
    df = spark.createDataFrame([(i, "abc"[i % 3]) for i in range(30)], "doc_id long, text string")
    prints = df.select("doc_id", F.lit(5).cast("long").alias("fp"), F.sha2("text", 256).alias("text_sha256"))
    monkeypatch.setattr(exact, "fingerprints", lambda rows: prints)
    def collide(batches):       # defined here, so that workers get it by value
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([5] * b.num_rows, pa.int64()), b.column(1).cast(pa.binary())],
                                             ["doc_id", "fp", "data"])

    monkeypatch.setattr(exact, "_normalised", collide)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact.exact_duplicates(df).collect()}
    assert got == {i: (27 + i % 3, 10) for i in range(30)}


def test_near(docs, texts, empty):
    sets = {}
    for i, t in texts:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").split()
        sets[i] = {tuple(w[p:p + 4]) for p in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                label[b] = a
    want = {i: (len(sets[i]), find(i), find(i) == i) for i in sets}
    for s in (near.Settings(shingle=4), near.Settings(shingle=4, block=3, leaders=1)):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near.near_duplicates(docs, settings=s).collect()}
        assert got == want
    assert near.near_duplicates(empty).count() == 0
    assert len({v[1] for v in want.values()}) < len(want)


def test_components_follow_long_chains(spark):
    n = 60
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 102), (102, 101)], "a long, b long")
    got = {r["node"]: r["label"] for r in near.components(links).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {100: 100, 101: 100, 102: 100}


def test_components_run_few_tasks_on_few_links(spark):
    """The driver keeps something of every task, so rounds read and write their edges in as many as the rows need."""
    links = spark.createDataFrame([(i, i // 2) for i in range(1, 40)], "a long, b long")
    settings = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    context, group = spark.sparkContext, "few-tasks"
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        context.setJobGroup(group, group)
        out = near.components(links)
        tracker = context.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
        tasks = [i.numTasks for i in map(tracker.getStageInfo, stages) if i and i.numCompletedTasks]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r["node"]: r["label"] for r in out.collect()} == {i: 0 for i in range(40)}
    assert out.rdd.getNumPartitions() <= context.defaultParallelism
    few = [n for n in tasks if n <= context.defaultParallelism]
    assert max(tasks) <= 97 and 2 * len(few) >= len(tasks) - 2, tasks


def test_fingerprints(spark, docs, texts, empty):
    rows = {r["doc_id"]: r for r in multiset.edited_fingerprints(docs).collect()}
    order = sorted((i, t or "") for i, t in texts)
    assert len(rows) == len(order)
    prints, near_edited, near_next = defaultdict(set), [], []
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        r = rows[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), sha(edited))
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (t == edited)
        prints[t].add(r["fingerprint"])
        if edited == t:
            assert r["near_edited"] == 1
        if len(t) > 300:
            near_edited.append(r["near_edited"])
            near_next.append(r["near_next"])
    assert sorted(near_edited)[len(near_edited) // 2] > 0.4 and sorted(near_next)[len(near_next) // 2] < 0.3
    assert all(len(p) == 1 for p in prints.values()) and len({min(p) for p in prints.values()}) == len(prints)
    assert multiset.edited_fingerprints(empty).count() == 0
    plan = multiset.edited_fingerprints(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_fingerprints_add_and_delete(spark):
    df = spark.createDataFrame([("a b\nc d", "e f g h i\nc d", "c d\ne f g h i\na b\nc d")], "x string, y string, z string")
    for c in "xyz":
        df = multiset.with_vector(df, F.col(c), f"v{c}")
    r = df.select((multiset.plus(F.col("vx"), F.col("vy")) == F.col("vz")).alias("p"),
                  (multiset.minus(F.col("vz"), F.col("vy")) == F.col("vx")).alias("m")).first()
    assert r["p"] and r["m"]


def test_likeness_of_very_long_texts(spark):
    """70,000 to 80,000 pieces a text, near_* against the cosine of the piece counts; one line comes 40,000 times."""
    rng = random.Random(3)
    many = [" ".join(f"{k}w{rng.randrange(10**9)}" for _ in range(4)) for k in range(80000)]
    other = [" ".join(f"{k}v{rng.randrange(10**9)}" for _ in range(4)) for k in range(80000)]
    texts = ["\n".join(many), "\n".join(other), "\n".join(["one and the same"] * 40000 + many[:30000]), "\n".join(other[:40000] + many[:35000])]
    assert len(texts[0].split()) > 300000
    df = spark.createDataFrame([(i, t, "en", "s", 0, False, 1, 2, 0.5) for i, t in enumerate(texts)], SCHEMA)

    def cosine(a, b):
        a, b = (Counter(" ".join(line.split()[k:k + 4]) for line in t.split("\n") for k in range(0, len(line.split()), 4)) for t in (a, b))
        return sum(n * b[p] for p, n in a.items()) / (sum(n * n for n in a.values()) * sum(n * n for n in b.values())) ** 0.5

    for r in multiset.edited_fingerprints(df).collect():
        text, after = texts[r["doc_id"]], texts[(r["doc_id"] + 1) % len(texts)]
        half = len(text) // 2
        assert abs(r["near_edited"] - cosine(text, text[:len(text) - half] + after[:half])) < 0.3
        assert abs(r["near_next"] - cosine(text, after)) < 0.3


def test_bpe(docs, texts, empty):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    vocab = bpe.vocabulary(path)
    tok = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
           for r in bpe.digests(bpe.encode(docs, path, public_tokenizers.PATTERN), path).collect()}
    for i, t in texts:
        ids = tok.encode_ordinary(t or "")
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        assert got[i] == (len(ids), hashlib.sha256(packed).hexdigest(), sha(t or ""))
    rng = random.Random(5)
    words = [bytes(rng.choice(b"abcdeat the ") for _ in range(rng.randint(1, 50))) for _ in range(3000)]
    words += [b"a" * n for n in range(2, 80)] + ["日本é".encode() * n for n in range(1, 9)]
    words = [w for w in words if w not in vocab.ranks]
    assert [list(memoryview(x).cast("I")) for x in vocab.replay(words)] == [tok._core_bpe.encode_single_piece(w) for w in words]
    assert bpe.encode(empty, path, public_tokenizers.PATTERN).count() == 0


def test_packing(spark, docs, texts, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    extra = [(100, "I'LL don't ½ ² <|endoftext|> ΑΣ x́\u0085y"), (101, "word " * 9000), (102, "ß Ä'S")]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string")).coalesce(2)
    pieces = packing.pack(df, path, settings=packing.Settings(window=256, bins=16, block=20000)).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for i, t in texts + extra:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p["start"]):
            part = ids[at:at + p["length"]]
            assert (p["start"], p["doc_tokens"]) == (at, len(ids))
            assert p["ids_crc32"] == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
            at += p["length"]
        assert at == len(ids)
    for own in by_sequence.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end and length > 0
            end += length
        assert end == 256 or end < 256 and end & (end - 1) == 0
    assert packing.pack(empty, path).count() == 0


def test_nnls():
    import numpy as np
    rng = np.random.default_rng(0)
    a = rng.random((12, 30))
    x = np.where(rng.random(30) < 0.2, rng.random(30), 0)
    found = packing.nnls(a, a @ x)
    assert (found >= 0).all() and np.abs(a @ found - a @ x).max() < 1e-6


def test_language(spark, empty):
    rng = random.Random(1)
    sounds = {"xx": "ba bo bi ".split(), "yy": "kru kra kri ".split(), "zz": "él èm oñ".split()}
    rows = [(i, " ".join("".join(rng.choice(sounds[c]) for _ in range(3)) for _ in range(30)), c)
            for i, c in enumerate(rng.choices(list(sounds), k=240))]
    rows += [(900, None, "xx"), (901, "123 456 !!", "yy"), (902, "", None), (None, rows[0][1], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df.where("doc_id < 120 or doc_id >= 900"), F.col("lang"))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(df, model).collect()}
    assert all(got[i][0] == c for i, _, c in rows[120:240])
    assert [got[i] for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert got[None][0] == rows[0][2] and all(0 <= s <= 1 for _, s in got.values())
    none = language.fit(empty, F.col("lang"))
    assert none.languages == [] and language.predict(df, none).where("lang_pred = 'und'").count() == len(rows)
    clash = df.withColumn("score", F.lit("x")).withColumn("row", F.lit(1))
    assert language.judged(clash, model).select("row.*").columns == clash.columns


def test_quality(spark, empty):
    rng = random.Random(2)
    rows = [(i, prose(rng, 40) if i % 3 else " ".join(w + "!!" for w in prose(rng, 40).upper().split()), int(i % 3 > 0)) for i in range(300)]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None), (901, ""), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows[:150]] + [(None, 1), (3, None), (5000, 1)], "doc_id long, quality int")
    got = {r["doc_id"]: r["score"] for r in quality.score(df, quality.fit(df, labels)).collect()}
    assert len(got) == 303 and all(0 <= s <= 1 for s in got.values())
    assert all((got[i] >= 0.7) == bool(y) for i, _, y in rows[150:])
    assert got[900] == got[901]
    assert quality.score(df, quality.fit(empty, labels)).where("score = 0.5").count() == 303


PAGE = """<!doctype html><html><head><title>t</title><script>var a="</p>";</script></head><body>
<header class=site-header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="cookie-notice"><p>We, use, cookies.</p></div><div id="main-content"><article><h1>A &amp; B</h1>
<p>First, with <b>bold</b>&nbsp;text<br>and   more.<p>Second&#33; <div class="advert">Buy, now</div>
<ul><li>one<li>two</ul><form><p>Name <input></p></form><blockquote>Quoted</blockquote></article>
<section class=comments><p>I, disagree, strongly, with, this.</p></section></div>
<aside><p>Side, bar</p></aside><footer>&copy; us</footer></body></html>"""


def test_html(spark):
    want = "A & B\nFirst, with bold text and more.\nSecond!\none\ntwo\nQuoted"
    assert html.main_text(PAGE) == want
    pages = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (None, "v", ""), (1, "u", PAGE), (3, "w", "<p>" * 3000 + "x")],
                                  "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("row", F.lit(0))
    got = Counter(tuple(r) for r in html.extract(pages).collect())
    assert got == Counter([(1, "u", want, len(want))] * 2 + [(2, None, "", 0), (None, "v", "", 0), (3, "w", "x", 1)])
    assert html.extract(pages.limit(0)).count() == 0


def test_html_self_closed_svg():
    body = "<article><p>First, one.</p>{}<p>Second, two.</p></article>"
    for icon in ("<svg/>", '<svg class="i" viewBox="0 0 1 1" />', "<SVG width=1 />"):
        assert html.main_text(icon + body.format("")) == "First, one.\nSecond, two."
        assert html.main_text(body.format(icon) + "<svg><path d='M0'/></svg>") == "First, one.\nSecond, two."
    assert html.main_text(body.format("<svg><text>no</text></svg>")) == "First, one.\nSecond, two."


LONG = "Prose, of some length, that goes on, and on, with commas, so that its container wins. " * 3


@pytest.mark.parametrize("outer", ["<article>{}</article>", "<main><article>{}</article></main>", "<main><div>{}</div></main>",
                                   "<div id=x>{}</div>", "<div><section>{}</section></div>"])
def test_html_keeps_what_stands_beside_the_best_container(outer):
    inner = ("<h1>Title</h1><div class=lead>Lead</div><div class=body>" + f"<p>{LONG}</p>" * 4 + "<ul><li>in list</li></ul></div>"
             "<ul><li>one</li><li>two</li></ul><blockquote>Quoted</blockquote><table><tr><td>1</td><td>2</td></tr></table>"
             "<figure><figcaption>Figure</figcaption></figure><section><p>Second</p></section><p>The end.</p>"
             "<div class=share>Share</div><ul><li><a href=a>other</a></li><li><a href=b>pages</a></li></ul>")
    page = f"<body><nav>Nav</nav>{outer.format(inner)}<footer>Foot</footer></body>"
    assert html.main_text(page).split("\n") == ["Title", "Lead", *[LONG.strip()] * 4, "in list", "one", "two", "Quoted", "1", "2",
                                                "Figure", "Second", "The end."]


def test_html_keeps_headers_and_elements_beside_the_article():
    p = f"<p>{LONG}</p>" * 3
    want = [LONG.strip()] * 3
    page = f"<body><article><header><h1>Title</h1></header><div>{p}</div></article></body>"
    assert html.main_text(page).split("\n") == ["Title", *want]
    page = f"<main><h1>Title</h1><article><div>{p}</div></article><article><p>Short one.</p></article></main>"
    assert html.main_text(page).split("\n") == ["Title", *want, "Short one."]
    page = f"<div>Head<table><tr><td>{p}</td></tr><tr><td>Next row</td></tr></table></div><p><a href=x>away</a></p>"
    assert html.main_text(page).split("\n") == ["Head", *want, "Next row"]


def test_pipeline(spark, docs, empty, tmp_path):
    import corpus_pipeline
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    now, sizes = docs.select(cols), []
    for _, function in corpus_pipeline.STAGES[:-1]:
        now = spark.createDataFrame(function(spark, now, "").collect(), now.schema)
        sizes.append(now.count())
        assert now.columns == cols
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] < docs.count()
    ids = {r["doc_id"] for r in now.collect()}
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, "")
    assert {r["doc_id"] for r in pieces.collect()} == ids
    docs.select(cols).write.parquet(f"{tmp_path}/documents.parquet")
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == ids
    now = empty.select(cols)
    for _, function in corpus_pipeline.STAGES:
        now = function(spark, now, "")
        assert now.count() == 0


@pytest.fixture
def no_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    yield
    spark.conf.unset("spark.sql.exchange.reuse")


def test_ranges_hold_without_exchange_reuse(spark, no_reuse):
    rng = random.Random(9)
    shared = [prose(rng, 3) for _ in range(300)]
    texts = {i: "\n".join(rng.choice(shared) for _ in range(8)) for i in range(1500)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)
    first = {}
    for i in sorted(texts):
        for line in texts[i].split("\n"):
            first.setdefault(line, i)
    want = sum(first[x] < i for i, t in texts.items() for x in t.split("\n"))
    assert lines.line_bitmaps(df, partitions=40).agg(F.sum("n_dropped")).first()[0] == want
    after = {r["doc_id"]: r["before_id"] for r in multiset.followed(df, partitions=40).collect()}
    assert after == {i: (i - 1) % 1500 for i in range(1500)}


def test_lines_and_fingerprints_of_repeated_rows_and_null_ids(spark):
    line = "one line that several documents share"
    rows = [(None, line), (None, line + "\nown"), (3, line), (3, line), (4, f"{line}\n{line}\nrest of four"), (5, None), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(map(tuple, lines.kept_lines(df, lines.line_bitmaps(df)).collect()))
    assert got == Counter([(None, 1, 0, line), (None, 2, 0, line + "\nown"), (3, 1, 1, ""), (3, 1, 1, ""), (4, 3, 2, "rest of four"),
                           (5, 1, 0, ""), (5, 1, 0, "")])
    prints = multiset.edited_fingerprints(df).collect()
    assert Counter((r["doc_id"], r["n_chars"]) for r in prints) == Counter(
        [(None, len(line)), (None, len(line) + 4), (3, len(line)), (4, 2 * len(line) + 14), (5, 0)])


def test_fingerprint_lanes(spark):
    """The exact lanes recomputed from the paragraphs one by one."""
    text = "a b\nc d\n\na b\nlast"
    df = multiset.with_vector(spark.createDataFrame([(text,)], "t string"), F.col("t"), "v")
    vector = df.first()["v"]
    parts = spark.createDataFrame([(p,) for p in text.split("\n")], "p string")
    for lane in range(multiset.EXACT):
        hashes = [r[0] for r in parts.select(F.xxhash64(F.lit(lane), "p")).collect()]
        assert vector[lane] == sum(hashes) % (1 << multiset.EXACT_BITS)


def test_language_needs_letters(spark):
    rows = [(i, f"word{'abc'[i % 3] * 3} " * 9, "xy"[i % 2]) for i in range(40)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.col("lang"))
    texts = ["½ ² ①", "Ⅷ ٣ 12", "_-_", "ª", "é", "日本"]
    got = language.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    assert [r["lang_pred"] == "und" for r in sorted(got)] == [not any(c.isalpha() for c in t) for t in texts]
    assert all(r["score"] == 0 for r in got if r["lang_pred"] == "und")


def test_language_sample_is_bounded_and_holds_rare_languages(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(1, prose(rng, 5), "en")] * 40 + [(2, prose(rng, 5) + str(i), "en") for i in range(300)] + [(3, "ñandú él oñ " * 4, "zz")]
    rows += [(4, "ñandú él oñ " * 5, None), (None, "x y", "en"), (5, None, "zz")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    load = language.np.linalg.eigh
    monkeypatch.setattr(language.np.linalg, "eigh", lambda m: seen.append(len(m)) or load(m))
    model = language.fit(df, F.col("lang"), settings=language.Settings(sample=40))
    assert seen == [40] and model.languages == ["en", "zz"]
    assert language.predict(df, model).where("doc_id = 4").first()["lang_pred"] == "zz"


def test_language_equals_plain_kernel_ridge(spark):
    """Scores against the kernel matrix of all rows, with every row a landmark."""
    import numpy as np
    rng = random.Random(6)
    sounds = {"xx": "ba bo bi ".split(), "yy": "kru kra bi ".split(), "zz": "él ba oñ".split()}
    rows = [(i, " ".join("".join(rng.choice(sounds[c]) for _ in range(2)) for _ in range(6)), c)
            for i, c in enumerate(rng.choices(list(sounds), k=200))]
    s = language.Settings(landmarks=200)
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.col("lang"), settings=s)
    sets = [set(language.present(t, s).tolist()) for _, t, _ in rows]

    def kernel(a, b):
        return np.array([[len(x & y) / (len(x) * len(y)) ** 0.5 for y in b] for x in a])
    k = kernel(sets, sets)
    y = np.array([[1.0 if c == x else -1.0 for x in model.languages] for _, _, c in rows])
    weight = ((y > 0) / (y > 0).mean(axis=0) / len(y)).sum(axis=1)
    values, vectors = np.linalg.eigh(k)
    good = values > 1e-6
    f = vectors[:, good] * np.sqrt(values[good])
    w = np.linalg.solve(f.T @ (f * weight[:, None]) + s.ridge * np.eye(f.shape[1]), f.T @ (y * weight[:, None]))
    texts = ["bababo krukra", "élélba oñ", rows[3][1]]
    want = kernel([set(language.present(t, s).tolist()) for t in texts], sets) @ (vectors[:, good] / np.sqrt(values[good])) @ w
    assert np.abs(model.scores(texts)[0] - want).max() < 0.01


def test_quality_sample_is_bounded(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(7, prose(rng, 10) + str(i)) for i in range(300)] + [(8, prose(rng, 9))] * 50 + [(9, prose(rng, 60000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1), (7, 1), (8, 0), (9, 0)], "doc_id long, quality int")
    taken = []
    monkeypatch.setattr(quality, "ftrl", lambda rows, s: taken.append(rows))
    quality.fit(docs, labels, settings=quality.Settings(sample=40))
    quality.fit(docs, labels, settings=quality.Settings(sample=400, entries=3000))
    quality.fit(docs, labels)
    assert [len(t) for t in taken] == [40, len(taken[1]), 302]
    assert 0 < sum(len(f) for f, _, _ in taken[1]) <= 3000
    assert all(abs(x.sum() - quality.Settings().scale) < 1e-6 for _, x, _ in taken[2])


def test_ftrl_equals_a_plain_loop():
    import math

    import numpy as np
    rng, s = np.random.default_rng(3), quality.Settings(bits=4, epochs=2)
    rows = [(np.unique(rng.integers(0, 16, 5)), None, int(rng.random() < 0.4)) for _ in range(30)]
    rows = [(f, rng.random(len(f)), y) for f, _, y in rows]
    z, n = [0.0] * 17, [0.0] * 17

    def weight(i):
        if abs(z[i]) <= s.l1:
            return 0.0
        return -(z[i] - math.copysign(s.l1, z[i])) / ((s.beta + math.sqrt(n[i])) / s.alpha + s.l2)
    good = sum(y for _, _, y in rows)
    for epoch in range(2):
        for k in np.random.default_rng(epoch).permutation(30):
            f, x, y = rows[k]
            entries = [*zip(f.tolist(), x.tolist()), (16, 1.0)]
            w = {i: weight(i) for i, _ in entries}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in entries)))
            for i, v in entries:
                g = (p - y) * v * (15 / good if y else 15 / (30 - good))
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / s.alpha
                z[i] += g - sigma * w[i]
                n[i] += g * g
    model = quality.ftrl(rows, s)
    assert np.allclose([*model.weights, model.bias], [weight(i) for i in range(17)], atol=1e-5)


def test_pipeline_stages_against_brute_force(spark):
    import corpus_pipeline
    rng = random.Random(12)
    base = prose(rng, 80).split()
    near_copy = " ".join([*base[:40], "other", *base[41:]])
    rows = [(1, " ".join(base)), (2, near_copy), (3, "Same Text here"), (3, "Same Text here"), (3, "same text HERE"), (4, "same text here"),
            (4, "same text here"), (4, "same text here"), (5, near_copy + " and more"), (5, "an own text with the id five"), (6, None), (6, ""),
            (None, "without an id"), (None, "without an id"), (7, "½ 12"), (8, prose(rng, 30))]
    names = "doc_id long, text string, lang string, source string, n_chars long, row int, rest string, n int, text_hash string"
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 0, "r", 2, "h") for i, t in rows], names)

    def after(name, df):
        out = dict(corpus_pipeline.STAGES)[name](spark, df, "")
        assert out.columns == df.columns
        return spark.createDataFrame(out.collect(), df.schema), Counter((r["doc_id"], r["text"]) for r in out.collect())
    kept, got = after("language_id", docs)
    assert got == Counter((i, t) for i, t in rows if any(c.isalpha() for c in t or ""))
    kept, got = after("exact_dedup", docs)
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").lower()].append((i is not None, i or 0))
    assert Counter((i, (t or "").lower()) for i, t in got.elements()) == Counter((m[1] if m[0] else None, t) for t, m in (
        (t, max(g)) for t, g in groups.items()))
    kept, got = after("minhash_near_dedup", kept)
    group = {(1, " ".join(base)), (2, near_copy), (5, near_copy + " and more")}
    want = {(i, t) for i, t in rows if i in (4, 7, 8, None)} | {(5, "an own text with the id five")}
    assert {(i, t) for i, t in got if t} - group == want and len(group & set(got)) == 1 and max(got.values()) == 1
    kept, got = after("minhash_near_dedup", docs)
    assert max(got.values()) == 1 and len(group & set(got)) == 1
