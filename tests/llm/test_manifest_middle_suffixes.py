"""Suffix-array dedup, Merkle manifest and fill-in-middle against brute force, on small tables with odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import merkle, middle, suffixes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row int, at int, key string, tree string, node int"
EXTRA = (1, 2, "k", "t", 3)
WORDS = "alpha beta gamma délta ñandú zeta 日本 theta".split()


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 60)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    passage, base = prose(rng, 40), prose(rng, 300)
    texts = [None, "", "x", "a" * 5000, "ab" * 3000, "a" * 99, "a" * 100, passage, passage * 2, base, prose(rng, 9000), "\x00" * 300 + "b",
             "\x00" * 300, "has <M> inside", "<", "<P", "é" * 120, "\n\n", "<<S>"]
    for k in range(60):
        words = base.split()
        for _ in range(rng.randint(0, 8)):
            words[rng.randrange(300)] = f"c{rng.randint(0, 999)}"
        texts += [" ".join(words) if k < 15 else prose(rng, rng.randint(1, 60)),
                  f"{prose(rng, rng.randint(0, 9))} {passage} {prose(rng, rng.randint(0, 9))}"]
    return [(i * 7 % 1009, t, rng.choice(["en", "en", "es", None]), rng.choice(["a", "ü", None]), rng.choice([len(t or ""), None]))
            for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def byte_dedup(rows, window=100):
    """(id, text) in corpus order -> (bytes, removed, spans, kept)"""
    seen, out = set(), []
    for _, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - window + 1):
            if b[p:p + window] in seen:
                gone[p:p + window] = b"\1" * window
            seen.add(b[p:p + window])
        spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return out


def removed(df, **settings):
    out = suffixes.without_runs(df, suffixes.repeated_runs(df, **settings), window=settings.get("window", 100))
    return [(r["doc_id"], (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))) for r in out.collect()]


@pytest.mark.parametrize("settings", [{}, {"often": 4, "dictionary": 16}, {"often": 1 << 30, "dictionary": 1}, {"window": 64}])
def test_suffixes(docs, rows, settings):
    order = sorted((r[:2] for r in rows), key=lambda r: r[0])
    want = dict(zip([i for i, _ in order], byte_dedup(order, settings.get("window", 100))))
    got = removed(docs, **settings)
    assert dict(got) == want and len(got) == len(want)
    assert sum(w[1] for w in want.values()) > 10000


def test_suffixes_repeated_and_null_ids(spark, empty):
    rng = random.Random(3)
    a, b = prose(rng, 30), prose(rng, 30)
    rows = [(None, a), (None, b + a), (1, a), (1, a), (2, b), (2, "x" + b), (3, None), (3, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keys = {(r["doc_id"], r["text"]): r["h"] for r in df.withColumn("h", F.xxhash64("text")).collect()}

    def place(r):       # null ids first, by their hash; the rows of an id by the last bits of theirs
        return r[0] is not None, r[0] or 0, keys[r] if r[0] is None else keys[r] & suffixes.ROW_MASK
    order = sorted(set(rows), key=place)
    want = dict(zip(order, byte_dedup(order)))
    assert Counter(removed(df)) == Counter((r[0], want[r]) for r in rows)
    assert removed(empty) == []
    with pytest.raises(ValueError):
        suffixes.repeated_runs(df, window=40)


def test_parse_covers_every_window_once(monkeypatch):
    monkeypatch.setattr(suffixes, "PORTION", 700)
    rng = np.random.default_rng(1)
    for text in (bytes(rng.integers(0, 256, 5000, np.uint8)), b"a" * 3000, b"ab" * 1500, bytes(rng.integers(97, 99, 2500, np.uint8)), b"z" * 100):
        starts, by_window = [], defaultdict(set)
        for at, n, trigger, _ in suffixes.phrases(text, 100):
            assert n.max() <= 100 - suffixes.GRAM + 1
            for a, k, t in zip(at.tolist(), n.tolist(), trigger.tolist()):
                starts += range(a, a + k)
                for p in range(a, a + k):
                    by_window[text[p:p + 100]].add(t)
        assert starts == list(range(len(text) - 99))
        assert all(len(t) == 1 for t in by_window.values())
    assert list(suffixes.phrases(b"z" * 99, 100)) == []


def test_suffix_array_is_in_byte_order():
    rng = random.Random(2)
    dictionary = np.frombuffer(bytes(rng.choice(b"ab\x00\xff") for _ in range(600)) * 2, np.uint8)
    starts = np.arange(len(dictionary) - 63)
    order, differs = suffixes.suffix_array(dictionary, starts, 64)
    text = dictionary.tobytes()
    assert order.tolist() == sorted(starts.tolist(), key=lambda p: (text[p:p + 64], p))
    inner = [text[p:p + 64] for p in order]
    assert differs.tolist() == [True] + [x != y for x, y in zip(inner, inner[1:])]
    phrase, first, size = suffixes.repeats(np.array([1, 1, 2, 3, 3]), np.array([2, 1, 1, 1, 1]),
                                           pa.array([b"x" * 64 + b"y", b"x" * 63 + b"y", b"q" * 64, b"r" * 64, b"s" * 64]), 64)
    assert (phrase.tolist(), first.tolist(), size.tolist()) == ([1], [0], [1])


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def fold_all(nodes):
    """Root, and every leaf's siblings as (side it stands on, digest)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            if i ^ 1 < len(nodes):
                paths[k].append((i & 1, nodes[i ^ 1]))
            else:
                paths[k].append((0, ""))
            at[k] = i >> 1
        nodes = [sha("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def brute_manifest(rows):
    groups = defaultdict(list)
    for i, text, lang, source, n in rows:
        own = [field(x) for x in (i, source, lang, n, text)]
        changed = i is not None and n is not None and zlib.crc32(str(i).encode()) % 7 == 0
        other = [*own[:3], field(n + 1), own[4]] if changed else own
        groups[lang].append((i is not None, i or 0, sha("".join(own)), sha("".join(other)), i))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    inner = {lang: fold_all([r[2] for r in sorted(groups[lang])]) for lang in langs}
    root, tops = fold_all([inner[lang][0] for lang in langs])
    out = []
    for lang, top in zip(langs, tops):
        subroot, paths = inner[lang]
        for (_, _, leaf, other, i), path in zip(sorted(groups[lang]), paths):
            now = other
            for side, sibling in path + top:
                now = sha(sibling + now if side else now + sibling)
            out.append((i, leaf, subroot, root, sha("".join(s for _, s in path + top)), now, now == root))
    return Counter(out)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def manifest(df):
    changed = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0, F.lit(1)).otherwise(F.lit(0))
    proofs = merkle.manifest(df, ["doc_id", "source", "lang", "n_chars", "text"], "lang",
                             claimed={"n_chars": F.col("n_chars").cast("decimal(20,0)") + changed})
    return merkle.verified(proofs)


@pytest.mark.parametrize("bits,ranges", [(10, 100_000), (2, 30), (1, 20)])
def test_merkle(docs, rows, monkeypatch, bits, ranges):
    monkeypatch.setattr(merkle, "BITS", bits)
    monkeypatch.setattr(merkle, "ROWS_PER_RANGE", ranges)
    got = Counter(tuple(r[c] for c in COLUMNS) for r in manifest(docs).collect())
    assert got == brute_manifest(rows)
    assert {r[-1] for r in got} == {True, False}


def test_merkle_odd_tables(spark, docs, empty, monkeypatch):
    monkeypatch.setattr(merkle, "BITS", 1)
    assert manifest(empty).count() == 0
    most = (1 << 63) - 1
    for rows in ([(1, "only", "en", "s", 4)], [(7, "a", "en", None, most), (7, "a", "en", None, most), (None, None, "", "s", None),
                 (None, "b", None, "s", 1), (7, "c", "en", "s", 1), (3, "", "é", "s", 0), (-14, "z" * 200000, "z", "", 2)]):
        df = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)
        assert Counter(tuple(r[c] for c in COLUMNS) for r in manifest(df).collect()) == brute_manifest(rows)


def brute_middle(doc_id, text):
    text = text or ""
    u = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    x = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(x[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(u)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(t in text for t in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    form = "spm" if h[3] % 100 < 20 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, len(p), len(m), sha(out), sha(text)


@pytest.mark.parametrize("piece", [4096, 3])
def test_middle(spark, docs, rows, empty, piece):
    df = docs.select("doc_id", "text")
    more = [(None, "no id <S"), (None, None), (5000, "twice\n  日本"), (5000, "twice\n  日本"), (5000, "other"), (5001, "")] + [
        (6000 + k, "ab <P ab> <S é" * (k % 7) + chr(0x1F600) * (k % 3)) for k in range(300)]
    got = middle.fill_in_middle(df.union(spark.createDataFrame(more, "doc_id long, text string")), piece_units=piece).collect()
    assert Counter(map(tuple, got)) == Counter(brute_middle(i, t) for i, t in [r[:2] for r in rows] + more)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert middle.fill_in_middle(empty).count() == 0


def test_middle_pieces_join_to_the_output(docs, rows):
    outputs = defaultdict(list)
    for r in middle.output_pieces(docs, piece_units=50).collect():
        outputs[r["doc_id"]].append((r["at"], bytes(r["data"])))
    assert {i: sha(b"".join(d for _, d in sorted(own))) for i, own in outputs.items()} == {r[0]: brute_middle(*r[:2])[5] for r in rows}
