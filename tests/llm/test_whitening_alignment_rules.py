"""Whitening, tokenizer alignment and URL rules against plain versions of themselves."""

import collections
import hashlib
import itertools
import json
import math
import random

import numpy as np
import pytest

from tidemark.llm import alignment, queries, url_rules, whitening
from tidemark.llm.byte_bpe import byte_characters
from tests.conftest import SF001

VECTORS = "vec_id long, embedding array<double>, label int, n long, e string, dims string, w string"


# ------------------------------------------------------------------ whitening
@pytest.mark.parametrize("spectrum", ["spread", "equal", "pairs", "steep", "low rank"])
def test_leading_components_equal_a_full_decomposition(spectrum):
    rng = np.random.default_rng(5)
    for d in (1, 2, 7, 40):
        q, _ = np.linalg.qr(rng.standard_normal((d, d)))
        e = {
            "spread": rng.random(d), "equal": np.ones(d), "pairs": np.repeat(rng.random(d), 2)[:d],
            "steep": 10.0 ** -np.arange(d), "low rank": np.where(np.arange(d) < 3, 1.0, 0.0),
        }[spectrum]
        v = (q * e) @ q.T
        values, vectors = whitening.leading_components((v + v.T) / 2, 8)
        real = min(8, int((e > 1e-12).sum()))
        assert len(values) >= min(real, 7 if spectrum == "steep" else 8)
        assert np.allclose(values, np.sort(e)[::-1][: len(values)], atol=1e-13)
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
        assert np.abs(v @ vectors - vectors * values).max() < 1e-12


def test_inertia_counts():
    rng = np.random.default_rng(6)
    v = rng.standard_normal((30, 30))
    v = v + v.T
    shifts = np.linspace(-20, 20, 41)
    counts = whitening.count_above(whitening.tridiagonal(v), shifts)
    assert counts.tolist() == [int((np.linalg.eigvalsh(v) > s).sum()) for s in shifts]


def _plain_whitening(rows):
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in rows]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    y = np.array([[float(n * r[j] - s[j]) / n for j in range(d)] for r in x])
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    deviations = [sum((n * r[j] - s[j]) ** 2 for j in range(d)) for r in x]
    return n, deviations, values[::-1], y @ vectors[:, ::-1] / np.sqrt(np.maximum(values[::-1], 1e-300)), np.trace(v)


def test_whiten_equals_plain(spark):
    rng = random.Random(8)
    good = [[rng.gauss(0, j + 0.5) for j in range(11)] for _ in range(90)]
    good += [good[0]] * 60  # a repeated vector
    rows = [(i if i % 7 else None, v, 1, 2, "x", "y", "z") for i, v in enumerate(good)]
    bad = [None, [1.0] * 10 + [None], [float("nan")] * 11, [float("inf")] + [0.0] * 10, [], [1.0, 2.0]]
    rows += [(1000 + i, v, None, None, None, None, None) for i, v in enumerate(bad)]
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(5)).collect()
    n, deviations, values, white, trace = _plain_whitening(good)
    assert len(got) == len(good) * 8 and {r.n for r in got} == {n}
    assert {r.component for r in got} == set(range(1, 9))
    assert max(r.identity_error for r in got) < 1e-9
    for k in range(8):
        mine = [r for r in got if r.component == k + 1]
        assert all(abs(r.explained - values[k] / trace) < 1e-9 for r in mine)
        want = collections.Counter((i if i % 7 else None, dev, round(abs(w), 6)) for i, (dev, w) in enumerate(zip(deviations, white[:, k])))
        assert collections.Counter((r.vec_id, r.deviation, round(abs(r.whitened), 6)) for r in mine) == want
        # one sign for all rows
        signs = {np.sign(r.whitened) * np.sign(white[r.vec_id, k]) for r in mine if r.vec_id is not None and abs(r.whitened) > 1e-6}
        assert len(signs) == 1


def test_whiten_without_directions(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).count() == 0
    for vectors in ([None], [[]], [[1.0, 2.0]], [[0.5, 0.5]] * 4):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
        assert whitening.whiten(df).count() == 0
    # one direction varies: one component; large entries stay exact
    df = spark.createDataFrame([(i, [1e12 * i, 3.0]) for i in range(3)], "vec_id long, embedding array<double>")
    got = sorted(whitening.whiten(df).collect(), key=lambda r: r.vec_id)
    assert [r.component for r in got] == [1, 1, 1] and got[1].deviation == 0
    assert got[0].deviation is None  # (3 * 1024e12)^2 is beyond 64 bits
    assert abs(abs(got[0].whitened) - math.sqrt(1.5)) < 1e-9


def test_op11_on_its_table(spark):
    got = queries.QUERIES["op11_embedding_whitening"](spark, SF001)
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").collect()
    good = [(r.vec_id, r.embedding) for r in rows if r.embedding is not None and all(c is not None and math.isfinite(c) for c in r.embedding)]
    n, deviations, values, white, trace = _plain_whitening([v for _, v in good])
    by = {(r.vec_id, r.component): r for r in got.collect()}
    assert len(by) == 8 * len(good)
    for i, (vec_id, _) in enumerate(good):
        for k in range(8):
            r = by[vec_id, k + 1]
            assert r.n == n and r.deviation == deviations[i]
            assert abs(abs(r.whitened) - abs(white[i, k])) < 1e-6 and abs(r.explained * trace / values[k] - 1) < 1e-6


# ------------------------------------------------------------------ alignment
def _paths():
    import public_tokenizers

    return public_tokenizers.path(queries.TOKENIZER_A), public_tokenizers.path(queries.TOKENIZER_B)


def _plain_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = _paths()
    a_model, b_model = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    a_model.encode_special_tokens = True
    byte = {c: i for i, c in enumerate(byte_characters())}

    def align(text):
        if not text:
            return None
        a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
        raw_a = [bytes(byte[c] for c in a_model.id_to_token(i)) for i in a]
        raw_b = []
        for i in b:
            piece = b_model.id_to_piece(i)
            raw_b.append(bytes([int(piece[3:5], 16)]) if b_model.is_byte(i) else piece.replace("▁", " ").encode())
        if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            return None
        ends = [{e: i for i, e in enumerate(itertools.accumulate(map(len, raw)))} for raw in (raw_a, raw_b)]
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            p, q = ends[0][end] + 1, ends[1][end] + 1
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            links.append((a[p - 1], b[q - 1]))
            i, j = p, q
        return len(a), len(b), groups, links

    found = [(d, align(t)) for d, t in rows]
    counts = collections.Counter(link for _, x in found if x for link in x[3])
    highest = collections.defaultdict(int)
    for (_, b), c in counts.items():
        highest[b] = max(highest[b], c)
    out = collections.Counter()
    for d, x in found:
        if x is None:
            out[d, 0, 0, 0, 0, 0, 0, ""] += 1
        else:
            n_a, n_b, groups, links = x
            best = sum(counts[link] == highest[link[1]] for link in links)
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
            out[d, n_a, n_b, len(groups), len(links), best, sum(counts[link] for link in links), digest] += 1
    return out


def _measures(df):
    names = ["doc_id", *alignment.MEASURES, "groups_sha256"]
    assert df.columns == names
    return collections.Counter(tuple(r[c] for c in names) for r in df.collect())


def test_align_documents_equals_plain(spark, monkeypatch):
    rng = random.Random(12)
    words = ["the", "naïve", "don't", "<s>", "<|endoftext|>", "<0x41>", "日本語", "🙂🙂", "  two", "tab\t", "x" * 40, "1234567", "café", "\n\n", " ", "é"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 30))) for _ in range(60)]
    texts += [None, "", " ", "  ", "▁", "a▁b", texts[0], texts[0], texts[1], " ".join(texts), "\r\n", "a"]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, key string, chunk string, n_a int, at string, count int"
    df = spark.createDataFrame([(*r, "k", "c", 1, "a", 2) for r in rows], schema).repartition(4)
    want = _plain_alignment(rows)
    assert _measures(alignment.align_documents(df, *_paths())) == want
    assert alignment.align_documents(spark.createDataFrame([], schema), *_paths()).count() == 0


def test_pieces_and_chunks_change_nothing(monkeypatch):
    a_path, b_path = _paths()
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:
        aligner = alignment.Aligner(f.read(), g.read())
    assert aligner.cuts
    rng = random.Random(13)
    parts = ["ab", "don't", " ", "  ", "\n ", " é", "7", ".", " \t", "日", "'s ", "\u00a0", "\x1c", "<s>"]
    texts = ["".join(rng.choice(parts) for _ in range(n)) for n in (1, 5, 50, 3000)] + ["x ▁ y", "a b"]
    for text in texts:
        pieces = aligner.cut(text)
        assert " ".join(pieces) == text
        a, b = aligner.encode(pieces)
        assert ([sum(a, [])], [sum(b, [])]) == tuple(aligner.encode([text]))
    assert len(aligner.cut(texts[3])) > 100
    # texts aligned alone, together, with few kept pieces and as whole texts: the same
    keys = [str(i).encode() for i in range(len(texts))]

    def groups(keys, texts):
        return {r[1]: r[2:7] for r in aligner.align(0, keys, texts, [1] * len(texts)) if r[1]}

    together = groups(keys, texts)
    assert together[b"4"] == (0, 0, 0, 0, "") and together[b"5"][0] == 2
    for key, text in zip(keys, texts):
        assert groups([key], [text])[key] == together[key]
    monkeypatch.setattr(alignment, "KNOWN", 3)
    assert groups(keys, texts) == together
    aligner.cuts = False
    assert groups(keys, texts) == together


def test_op12_on_its_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert _measures(queries.QUERIES["op12_tokenizer_alignment"](spark, SF001)) == _plain_alignment(rows)


# ------------------------------------------------------------------ URL rules
def _plain_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        at = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:at])
        rest = rest[at:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] + [len(rest)])]
    fitting = [
        (len(h + p), h + p, v) for v, h, p in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fitting, default=(0, None, None))
    return host, path, best[1], best[2]


URLS = [
    None, "", "no scheme", "http://", "://x.com/", "http://COM/", "http://a.B.com", "http://a.com?x=/en/", "https://example.com/en/1",
    "https://www.Example.com/en/1#f", "https://x.www.example.com/en/", "http://notexample.com/en/1", "http://net/es/", "http://a.net/ES/1",
    "http://a.net/fr/?q=1://b", "http://com.org/en/", "http://a.com:80/x", "http://é.com/ü", "ftp://a.net/fr", "a\nb://c.net/es/x\ny#z",
]


def _plain_tokens(url, host, path):
    if not host:
        return set()
    labels = host.split(".")
    out = {"host:" + x for x in labels[:-1]} | {"last:" + labels[-1]} | {"path:" + s for s in path.split("/") if s}
    query = url.split("#")[0].partition("?")[2]
    out |= {"query:" + q.split("=")[0] for q in query.split("&") if q.split("=")[0]}
    return out | {"scheme:" + url.split("://")[0]} | ({"ending:html"} if path.endswith(".html") else set())


def test_listed_rules_and_odd_urls(spark):
    long = "http://long.org/" + "seg/" * 5000
    rows = [(i if i else None, u, "x") for i, u in enumerate([*URLS, long, *URLS])]
    got = url_rules.judge(spark.createDataFrame(rows, "page_id long, url string, token string")).collect()
    want = collections.Counter((i, *_plain_rule(u)[:3]) for i, u, _ in rows)
    assert collections.Counter((r.page_id, r.host, r.path, r.rule) for r in got) == want
    given = {(i, u): _plain_rule(u)[3] for i, u, _ in rows}
    for r in got:
        assert r.verdict in ("allow", "block")
        if r.rule:
            assert r.verdict in {v for (i, _), v in given.items() if i == r.page_id}
    assert url_rules.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def _plain_mining(labelled, support, confidence, least_rows):
    n = len(labelled)
    least = math.ceil(max(support, least_rows / n) * n - 1e-9)
    tokens = sorted({t for ts, _ in labelled for t in ts})
    out = {}
    for size in range(1, 5):
        for items in itertools.combinations(tokens, size):
            having = [v for ts, v in labelled if set(items) <= ts]
            for verdict in ("allow", "block"):
                both = having.count(verdict)
                if both >= least and both / len(having) >= confidence:
                    out[items, verdict] = (both / len(having), both / n)
    return {
        k: v for k, v in out.items()
        if all(v[0] > out.get((tuple(x for x in k[0] if x != y), k[1]), (-1,))[0] for y in k[0])
    }


def test_mined_rules_equal_plain_counts(spark):
    rng = random.Random(15)
    labelled = []
    for _ in range(300):
        ts = {t for t in "abcdef" if rng.random() < 0.5} | {"z"}
        share = 0.9 if {"a", "b"} <= ts else 0.2 if "c" in ts else 0.5
        labelled.append((ts, "block" if rng.random() < share else "allow"))
    df = spark.createDataFrame([(sorted(ts), v) for ts, v in labelled], "tokens array<string>, verdict string")
    rules, otherwise = url_rules.mine(df, 0.05, 0.7, 5)
    got = {(tuple(r.tokens), r.verdict): (r.confidence, r.support) for r in rules.collect()}
    want = {k: v for k, v in _plain_mining(labelled, 0.05, 0.7, 5).items()}
    large = {k: v for k, v in got.items() if len(k[0]) > 4}  # the plain version stops at four tokens
    assert set(got) - set(large) == set(want) and want
    assert all(abs(got[k][0] - want[k][0]) < 1e-12 for k in want)
    counts = collections.Counter(t for ts, _ in labelled for t in ts)
    assert all(r.token == min(r.tokens, key=lambda t: (counts[t], t)) for r in rules.collect())
    assert otherwise == ("block" if 2 * sum(v == "block" for _, v in labelled) > 300 else "allow")
    # matching by the index equals trying every rule on every set
    sets = [(str(i), sorted(ts)) for i, (ts, _) in enumerate(labelled[:80])] + [("none", [])]
    matched = {r.url: (r.mined, tuple(r.because)) for r in url_rules.match(spark.createDataFrame(sets, "url string, tokens array<string>"), rules).collect()}
    for name, ts in sets:
        fitting = [(-c, -s, len(k[0]), list(k[0]), k[1]) for k, (c, s) in got.items() if set(k[0]) <= set(ts)]
        best = min(fitting, default=None)
        assert matched.get(name) == (best and (best[4], tuple(best[3])))


def test_many_tokens_that_always_meet(spark):
    """Item sets grow as 2^k: a URL of many frequent tokens is mined by its most telling."""
    deep = "http://a.net/fr/" + "/".join(f"s{i}" for i in range(60))
    rows = [(i, deep if i % 3 else "https://b.com/x") for i in range(90)] + [(100, deep.replace("net", "org"))]
    got = url_rules.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert len(got) == 91 and [r.verdict for r in got if r.page_id == 100] == ["block"]


def test_all_tokens_of_a_row_are_mined(spark):
    """Two tokens tell the label only together, in rows of ten others that say no less
    each; and thirty tokens that always meet under both labels are no 2^30 sets."""
    others = [f"t{i}" for i in range(10)]
    kinds = [(others + ["z1", "z2"], "block"), (others + ["z1"], "allow"), (others + ["z2"], "allow"), (others, "block")]
    always = [f"w{i:02d}" for i in range(30)]
    kinds += [(always, "allow"), (always, "block")]
    df = spark.createDataFrame(kinds * 10, "tokens array<string>, verdict string")
    rules, _ = url_rules.mine(df, 0.05, 0.7, 5)
    assert [(r.tokens, r.verdict, r.confidence) for r in rules.collect()] == [(["z1", "z2"], "block", 1.0)]


def test_op13_on_its_table(spark):
    got = queries.QUERIES["op13_url_filters"](spark, SF001)
    assert got.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    rows = spark.read.parquet(f"{SF001}/pages.parquet").collect()
    want = {r.page_id: _plain_rule(r.url) for r in rows}
    out = got.collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.host, r.path, r.rule) == want[r.page_id][:3] and r.verdict in ("allow", "block")
        assert want[r.page_id][3] in (None, r.verdict)
    assert json.dumps([r.verdict for r in out])
