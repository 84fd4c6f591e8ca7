"""Parts that need no Spark: each against a plain version of itself."""

import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import byte_bpe, html_mincut, quality, sharding, simhash
from tidemark.llm import suffix_dedup as sd
from tidemark.llm.suffix_sort import sort_suffixes


def test_suffix_sort_equals_plain_sort():
    rng = np.random.default_rng(1)
    for _ in range(150):
        strings = []
        for _ in range(rng.integers(1, 9)):
            n = int(rng.integers(0, 50))
            s = rng.integers(1, 4, n) if rng.integers(2) else np.tile(rng.integers(1, 4, max(1, n // 7)), 7)
            strings.append(np.append(s, 0))
        ends = np.cumsum([len(s) for s in strings])
        got, a = sort_suffixes(np.concatenate(strings), ends), 0
        for s, e in zip(strings, ends):
            plain = s.tolist()
            assert (got[a:e] - a).tolist() == sorted(range(len(plain)), key=lambda i: plain[i:])
            a = e


def test_large_sets_of_contexts_are_split(monkeypatch):
    """The same windows are found whatever the size from which sets are split."""
    rng = random.Random(4)
    gram = "".join(rng.choice("ab ") for _ in range(60))
    texts = ["".join(rng.choice("xyz") for _ in range(rng.randint(20, 60))) + gram + rng.choice(["tail" * 15, "other" * 12, ""]) for _ in range(60)]
    data = [t.encode() for t in texts]
    ends = np.cumsum([len(d) for d in data])
    args = (np.frombuffer(b"".join(data), np.uint8), ends, np.zeros(60, np.int64), np.arange(60), np.zeros(60, np.int64), np.zeros(60, np.int64))
    keep = np.array([len(d) >= sd.LENGTH for d in data])
    lens = np.array([len(d) for d in data])
    buffer = np.frombuffer(b"".join(d for d, k in zip(data, keep) if k), np.uint8)
    args = (buffer, np.cumsum(lens[keep]), *[x[keep] for x in args[2:]])

    def spans():
        found = sd.repeated_windows(*args)
        return [x.tolist() for x in sd.merge(*[np.concatenate(x) for x in zip(*found)])]

    whole = spans()
    monkeypatch.setattr(sd, "STRING", 300)
    assert spans() == whole and whole[0]


def test_byte_bpe_equals_tiktoken():
    import public_tokenizers
    import tiktoken

    tokens = byte_bpe.read_ranks(None, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    codec = byte_bpe.Codec(byte_bpe.model_proto(tokens), tokens, public_tokenizers.PATTERN)
    plain = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={}
    )
    rng = random.Random(1)
    alphabet = "abcde the ing THE é ñ ü  \n\t 12'sll\x1c\x85\xa0　中文字кирил😀​\x00▁<unk>"
    for _ in range(800):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50)))
        ids = codec.encode(text)
        assert list(memoryview(ids).cast("I")) == plain.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()
    long = "word and more " * 100_000
    assert list(memoryview(codec.encode(long)).cast("I")) == plain.encode_ordinary(long)


def _plain_fingerprint(text):
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def test_fingerprint_equals_plain_one(monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["A", "bc", "É", "x\ty", "z\n"]) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    texts += ["", " \n", "one", "w" * 500, "two words"]
    whole = [simhash.fingerprint(t) % (1 << 64) for t in texts]
    assert whole == [_plain_fingerprint(t) for t in texts]
    monkeypatch.setattr(simhash, "PIECE", 16)  # long texts come in pieces
    assert [simhash.fingerprint(t) % (1 << 64) for t in texts] == whole


def _cut_value(score, links, side):
    cost = sum(s for s, k in zip(score, side) if s > 0 and not k) + sum(-s for s, k in zip(score, side) if s < 0 and k)
    return cost + sum(w for u, v, w in links if side[u] != side[v])


def test_min_cut_is_minimal():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randint(1, 8)
        score = [rng.uniform(-2, 2) for _ in range(n)]
        links = [(i, j, rng.uniform(0, 1.5)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.4]
        best = min(_cut_value(score, links, [m >> i & 1 for i in range(n)]) for m in range(1 << n))
        assert _cut_value(score, links, html_mincut.min_cut(score, links)) == pytest.approx(best)


def test_main_text_of_a_page():
    page = """<html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header>
    <nav><a href=x>Home</a></nav><div class="cookie-notice">We use cookies on this site, accept them all today.</div>
    <article><h1>Title &amp; more</h1><p>First   para<br>with text. It goes on.<p>Ok.</p><form><label>Mail</label></form>
    <aside>Related: <a href=y>foo bar</a></aside><p>&lt;Last&gt; one.</p></article>
    <section id="comments"><p>A reader says that this is a very nice long article, thanks for it.</p></section>
    <script>var a = "<p>no</p>";</script><footer>&copy; x</footer></body></html>"""
    assert html_mincut.main_text(page) == "Title & more\nFirst para with text. It goes on.\nOk.\n<Last> one."
    assert html_mincut.main_text("") == html_mincut.main_text("<p>") == html_mincut.main_text("<script>x") == ""


@pytest.mark.parametrize(
    "page",
    [
        "<body class='single has-sidebar'><div>{}</div></body>",
        "<div class='page no-sidebar'><article>{}</article></div>",
        "<article class='post comments-open'>{}</article>",
        "<div class='page no-sidebar'>{}</div>",
    ],
)
def test_names_of_the_page_drop_no_article(page):
    text = ["The first sentence of a story that has some words in it.", "A second one follows here, and it has as many words."]
    html = page.format("".join(f"<p>{t}</p>" for t in text) + "<div class='share-buttons'>Share this with friends</div>")
    html += "<section id='comments'><article class='comment'><p>I like it.</p></article></section>"
    assert html_mincut.main_text(html) == "\n".join(text)


def test_quality_learns_held_out_rows():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(200)]

    def doc(label):
        own = [rng.choice(words) for _ in range(60)]
        return " ".join(own) + "." if label else " ".join(w.upper() + "!!" for w in own)

    rows = [(i, doc(i % 4 != 0), int(i % 4 != 0)) for i in range(300)]
    learn = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    weights = quality.train([(r[0], *quality.features(r[1]), r[2]) for r in learn], quality.BITS, 3)
    other = [r for r in rows if r not in learn]
    assert sum((quality.score_text(r[1], weights) >= 0.5) == r[2] for r in other) / len(other) > 0.97
    assert 0 <= quality.score_text("", weights) <= 1


def test_features_of_blocks_are_those_of_the_whole_text(monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["a", "a", "B", "cd,", "!!", "Ef", "9"]) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    texts += ["x" * 400 + " end", "", "?" * 300]
    whole = [quality.features(t) for t in texts]
    monkeypatch.setattr(quality, "PIECE", 3)
    for size in (1, 2, 3, 7):  # blocks shorter than what is carried, too
        monkeypatch.setattr(quality, "BLOCK", size)
        for text, (columns, values) in zip(texts, whole):
            got = quality.features(text)
            assert np.array_equal(got[0], columns) and np.allclose(got[1], values, atol=0)


def test_training_equals_plain_updates():
    """Follow the regularised leader, spelt out by coordinate."""
    rng = random.Random(12)
    rows = [(i, np.array(sorted(rng.sample(range(16), 4))), np.array([rng.random() for _ in range(4)]), rng.randint(0, 1)) for i in range(40)]
    alpha, beta, l1, l2, z, n = 0.5, 1.0, 0.02, 0.1, [0.0] * 17, [0.0] * 17

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - (l1 if z[i] > 0 else -l1)) / ((beta + n[i] ** 0.5) / alpha + l2)

    for epoch in range(2):
        for r in np.random.default_rng(epoch).permutation(len(rows)):
            _, columns, values, label = rows[r]
            x = dict(zip(columns.tolist(), values.tolist())) | {16: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - label) * v
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha
                z[i], n[i] = z[i] + g - sigma * w[i], n[i] + g * g
    assert np.allclose(quality.train(rows, 4, 2), [weight(i) for i in range(17)])


def test_slot_map_edits():
    rng = random.Random(6)
    sizes = [rng.randint(0, 1000) for _ in range(2000)]
    old = sharding.first_map(sizes, 10)
    assert max(old.loads(sizes)) - min(old.loads(sizes)) <= max(sizes)
    new = sharding.edit_map(old, sizes, 11)
    loads = new.loads(sizes)
    moved = [s for s in range(2000) if old.shard_of[s] != new.shard_of[s]]
    assert sorted(new.moved) == moved and {new.shard_of[s] for s in moved} == {10} and new.version == 2
    assert loads[10] > 0.9 * sum(sizes) / 11
