"""Operators on small frames against plain versions, with nulls, empty and long
texts, ties, repeated rows, clashing column names and empty tables."""

import collections
import hashlib
import math
import random
import re
import struct
import time

import pytest
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, exact_dedup, html_mincut, mixing, pii, quality, sharding, simhash, suffix_dedup, winnowing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, fp string, bucket int, spans string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    base = " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 8))) for _ in range(600))
    out = []
    for i in range(40):
        a = rng.randint(0, 3000)
        text = base[a : a + rng.randint(0, 500)] + rng.choice(["", " eres" * 60, "é" * 130, "mail a.b@c.de or 10.0.0.255 now"])
        out.append([i * 1000, text])
    out += [[41, None], [42, ""], [43, " \t\n"], [44, out[3][1]], [45, " " + out[3][1]], [46, base], [46, base], [None, base], [None, None]]
    return [(d, t, rng.choice(["en", None]), rng.choice(["src0", "src1", None]), None, 1, "x", 2, "s") for d, t in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _plain_repeats(rows):
    seen, out = set(), []
    for d, t in sorted(((d if d is not None else 1 << 62, t or "") for d, t, *_ in rows), key=lambda r: (r[0], r[1])):
        data = t.encode()
        mark = bytearray(len(data))
        for p in range(len(data) - 99):
            s = data[p : p + 100]
            if s in seen:
                mark[p : p + 100] = b"\1" * 100
            seen.add(s)
        kept = bytes(x for x, m in zip(data, mark) if not m)
        out.append((None if d == 1 << 62 else d, len(data), sum(mark), len(re.findall(b"\1+", bytes(mark))), hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup(docs, rows, none):
    got = suffix_dedup.remove_repeats(docs).drop("spans").collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(_plain_repeats(rows), key=key)
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_exact_dedup(docs, rows, none):
    groups = collections.defaultdict(list)
    for d, t, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), d is None, d or 0))
    want = collections.Counter()
    for norm, members in groups.items():
        best = min(members)
        for n, z, d in members:
            want[(None if z else d, None if best[1] else best[2], len(members), hashlib.sha256(norm.encode()).hexdigest())] += 1
    for options in ({}, {"capacity": 3, "hash_bits": 5}):  # chains of several texts
        got = exact_dedup.exact_groups(docs, **options).collect()
        assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
        assert sum(r.kept for r in got) == len(groups)
    kept = exact_dedup.keep_first_copies(docs)
    assert kept.count() == len(groups) and kept.columns == docs.columns
    assert exact_dedup.exact_groups(none).count() == 0 and exact_dedup.keep_first_copies(none).count() == 0


def test_simhash_groups(docs, rows, none):
    fps = [(d, simhash.fingerprint(t or "") % (1 << 64)) for d, t, *_ in rows]
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 2:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(fps):
        least.setdefault(find(i), []).append(d)
    want = collections.Counter(
        (d, f"{fp:016x}", min((x for x in least[find(i)] if x is not None), default=None)) for i, (d, fp) in enumerate(fps)
    )
    got = simhash.near_groups(docs).collect()
    assert collections.Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    kept = simhash.keep_first_of_groups(docs)
    assert kept.count() == len(least) and kept.columns == docs.columns
    assert simhash.near_groups(none).count() == 0


def test_simhash_links_around_centres(spark):
    rng, values = random.Random(3), set()
    for _ in range(20):
        centre = rng.getrandbits(64)
        for _ in range(12):
            v = centre
            for _ in range(rng.randint(0, 4)):
                v ^= 1 << rng.randrange(64)
            values.add(v - (1 << 64) if v >> 63 else v)
    values = list(values)
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    for bits in (1, 2, 3):
        got = {frozenset(r) for r in simhash.links(df, bits).collect()}
        assert got == {frozenset((a, b)) for a in values for b in values if a < b and ((a ^ b) % (1 << 64)).bit_count() <= bits}


def test_sharding(docs, rows, none):
    got = sharding.shard_documents(docs, 5).collect()
    assert len(got) == len(rows)
    places = collections.defaultdict(list)
    for r in got:
        places[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in places.values())
    assert sum(r["size"] for r in got) == sum(len((t or "").encode()) + 8 for _, t, *_ in rows)
    assert sharding.shard_documents(none, 5).count() == 0


def test_winnowing(spark, none):
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(0, 80))) for _ in range(30)]
    ids = [rng.choice([i, i * 100_000]) + i for i in range(30)]
    rows = sorted(zip(ids, texts + []))
    got = {r.doc_id: r for r in winnowing.edited_likeness(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for (d, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        assert got[d].n_chars == len(t)
        assert got[d].edited_sha256 == hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest()
        assert 0 <= got[d].near_edited <= 1 and 0 <= got[d].near_next <= 1
        assert (got[d].near_edited == 1) == (got[d].fingerprint == got[d].edited_fingerprint)
        grams, at = max(len(t.split()) - winnowing.K + 1, bool(t.split())), got[d].positions
        assert at == sorted(set(at)) and set(at) <= set(range(grams))
        # every window of grams has one
        assert all(any(i <= p < i + winnowing.W for p in at) for i in range(max(grams - winnowing.W + 1, bool(grams))))
    edge = spark.createDataFrame([(1, None), (None, "a b"), (None, None), (2, "a b c d e f g h i j k l m"), (2, "x")], "doc_id long, text string")
    assert winnowing.edited_likeness(edge).count() == 5 and winnowing.edited_likeness(none).count() == 0


def test_winnowing_keeps_rightmost_minimum_per_window(spark):
    rng = random.Random(10)
    texts = [" ".join(rng.choice("ab") for _ in range(n)) for n in (0, 1, 3, 4, 11, 40)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    grams = winnowing.fingerprint(df, "text", "kept")
    every = winnowing.fingerprint(df, "text", "all_grams", w=1).select("text", "all_grams")
    for r in grams.join(every, "text").collect():
        alls = r.all_grams
        windows = [alls[i : i + 8] for i in range(max(1, len(alls) - 7))] if alls else []
        want = []
        for win in windows:
            low = min(x >> 30 for x in win)
            last = [x for x in win if x >> 30 == low][-1]
            if last not in want:
                want.append(last)
        assert r.kept == want


def _chained(values):
    import xxhash

    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<Q", v), seed)
    return seed


def _plain_kept(text, k=4, w=8):
    """(hash, position) of every kept gram, by the definition."""
    import xxhash

    words = [xxhash.xxh64_intdigest(x.encode(), 42) for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    if len(words) < k:
        grams = [_chained(words)] if words else []
    else:
        pairs = [_chained(words[i : i + 2]) for i in range(len(words) - 1)]
        grams = [_chained([pairs[i], pairs[i + 2]]) for i in range(len(words) - 3)]
    grams = [g >> 31 for g in grams]
    windows = range(max(1, len(grams) - w + 1)) if grams else []
    return {(min(grams[i : i + w]), max(p for p in range(i, min(i + w, len(grams))) if grams[p] == min(grams[i : i + w]))) for i in windows}


def test_winnowing_likeness_equals_plain_sets(spark):
    rng = random.Random(21)
    base = [rng.choice(["red", "blue", "é", "green", "12"]) + str(rng.randint(0, 9)) for _ in range(300)]
    texts = ["", None, "one", "two words", " \t\n"]
    for _ in range(40):
        a = rng.randint(0, 250)
        texts.append(rng.choice([" ", "  ", "\n"]).join(base[a : a + rng.randint(0, 90)]) + rng.choice(["", " tail", " 😀"]))
    texts += [texts[7], texts[7]]
    got = {r.doc_id: r for r in winnowing.edited_likeness(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}

    def dice(x, y):
        return 2 * len(x & y) / (len(x) + len(y)) if x or y else 1.0

    for i, text in enumerate(texts):
        text, after = text or "", texts[(i + 1) % len(texts)] or ""
        half = len(text) // 2
        own, edited, other = ({h for h, _ in _plain_kept(t)} for t in (text, text[: len(text) - half] + after[:half], after))
        assert (got[i].near_edited, got[i].near_next) == (pytest.approx(dice(own, edited)), pytest.approx(dice(own, other)))
        for found, grams in ((got[i].fingerprint, own), (got[i].edited_fingerprint, edited)):
            assert found == hashlib.sha256(",".join(map(str, sorted(grams))).encode()).hexdigest()


def test_winnowing_guarantees_a_match_at_its_place(spark):
    """k + w - 1 equal words in two texts share a kept gram, at places of that run."""
    rng = random.Random(22)
    run = winnowing.K + winnowing.W - 1
    pairs, places = [], []
    for i in range(60):
        shared = [rng.choice("abc") + str(rng.randint(0, 3)) for _ in range(run)]
        lead = [[f"l{side}x{rng.randint(0, 99)}" for _ in range(rng.randint(0, 20))] for side in (0, 1)]
        tail = [[f"t{side}x{rng.randint(0, 99)}" for _ in range(rng.randint(0, 20))] for side in (0, 1)]
        pairs += [(2 * i + s, " ".join(lead[s] + shared + tail[s])) for s in (0, 1)]
        places.append((len(lead[0]), len(lead[1])))
    kept = winnowing.fingerprint(spark.createDataFrame(pairs, "id int, text string"), "text", "kept").select(
        "id", F.transform("kept", lambda x: F.struct(winnowing.gram_hash(x), winnowing.gram_position(x))).alias("kept")
    )
    grams = {r.id: {tuple(x) for x in r.kept} for r in kept.collect()}
    assert all(grams[i] == _plain_kept(t) for i, t in pairs)
    for i, (x, y) in enumerate(places):
        assert any((h, p - x + y) in grams[2 * i + 1] for h, p in grams[2 * i] if x <= p <= x + run - winnowing.K)


def test_successors(spark):
    values = [3, 7, 8, 9000, 9001, 20_000_000, 5 * 10**15, -5, -70_000]
    got = dict(winnowing.successors(spark.createDataFrame([(v,) for v in values], "v long")).collect())
    ordered = sorted(values)
    assert got == dict(zip(ordered, ordered[1:] + [None]))


def test_mixing_budgets(spark, docs, none):
    # one short source: its siblings take over, then the other language
    leaves = spark.createDataFrame(
        [("d", "en", "a", 10), ("d", "en", "b", 1000), ("d", "de", "c", 1000)], "domain string, lang string, source string, supply long"
    )
    given = {r.source: r.given for r in mixing.budgets(leaves, {}, 600, 1).collect()}
    assert given == {"a": 10, "b": 290, "c": 300}
    given = {r.source: r.given for r in mixing.budgets(leaves, {}, 5000, 1).collect()}
    assert given == {"a": 10, "b": 1000, "c": 1000}
    twice = mixing.mix(docs, max_epochs=2, budget_percent=150).collect()
    assert {r.copies for r in twice} <= {1, 2} and twice
    assert mixing.mixed_documents(docs).columns == docs.columns
    assert mixing.mix(none).count() == 0


def test_mixing_repeats_short_sources(spark):
    """With the registered number of passes a short language reaches its weight, and
    the rows of the mixture are those copies, by leaf."""
    rows = [(i, f"t{i} " * 10, "en" if i < 100 else "de", "s0") for i in range(300)]
    rows += [(i, rows[i][1], "de", "s0") for i in range(5)]  # equal id and text, other leaf
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    weights = {"lang": {"en": 5, "de": 1}}
    taken = mixing.mix(df, weights=weights)
    shares = {r.lang: r for r in mixing.reached_shares(df, taken, weights).filter("level = 'lang'").collect()}
    assert shares["en"].target == pytest.approx(5 / 6)
    assert shares["en"].reached == pytest.approx(5 / 6, abs=0.01)
    want = collections.Counter()
    for r in taken.collect():
        want[r.doc_id, r.lang] += r.copies
    got = mixing.mixed_documents(df, weights=weights).select("doc_id", "lang").collect()
    assert collections.Counter(map(tuple, got)) == want and {want[i, "en"] for i in range(100)} == {2, 3}


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _plain_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0
            fine = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15,
            }
            if fine[kind]:
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


def test_pii_base_spans(spark):
    rng = random.Random(5)
    parts = ["a", "b.c", "@", ".", "x-y", "_", "1", "12", "255", "256", "0.", "4425414259157784", "4425 4142 5915 7784", " ", "-", "+",
             "+1 (555) 444-3322", "é", "😀", "\n", "10.0.0.1", "(", ")", "foo@bar.com", "1.2.3.4.5.6.7.8", "+49 30 1234567"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(800)]
    long = ["a" * 50_000, "1" * 50_000, "1 " * 20_000]
    df = spark.createDataFrame(list(enumerate(texts + long)), "doc_id long, text string")
    got = dict(pii.base_spans(df).select("doc_id", pii.spans_text(F.col("spans"))).collect())
    assert [got[i] for i in range(len(texts))] == [_plain_spans(t) for t in texts]
    assert all(got[len(texts) + i] == "" for i in range(3))


def test_pii_terms_and_sanitising(spark, docs, none):
    toy = [(i, f"lorem{i} ipsum the secretclub zz mail joe@x.org called the and {i}") for i in range(6)]
    toy += [(100 + i, f"the and other words {i} mail lorem ipsum dolor zz the called") for i in range(60)]
    df = spark.createDataFrame(toy + [(7, None), (None, "x joe@x.org")], "doc_id long, text string")
    found = pii.find_spans(df).join(df.select("doc_id", "text"), "doc_id").withColumn("clean", pii.sanitise(F.col("text"), F.col("spans")))
    got = {r.doc_id: r for r in found.collect()}
    assert "[EMAIL]" in got[0].clean and "secretclub" not in got[0].clean and " the " in got[0].clean
    assert [s.kind for s in got[0].spans] == ["term", "email"] and not got[100].spans
    assert pii.find_spans(docs).count() == docs.count() and pii.find_spans(none).count() == 0


def _least_share(k, n, z=pii.Z):
    p = k / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


@pytest.mark.parametrize("threshold, together", [(pii.THRESHOLD, pii.MIN_TOGETHER), (0.6, 1)])
def test_pii_terms_equal_plain_counts(spark, threshold, together):
    """An entity of one text, terms far from it, copies that differ in case."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 4))) for _ in range(400)]
    mails = ["solo@x.org", "two@x.org", "two@x.org", "Three@x.org", "three@x.org", "three@x.org"]
    texts = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(200)]
    for i, mail in enumerate(mails):
        tail = " ".join(rng.choice(words) for _ in range(40))
        texts[i] = f"{mail} {texts[i]} {tail} mark{'abc'[min(i, 2)]}here"
    texts[0] += " unheardof"
    texts += [texts[0].upper(), texts[3], None, ""]
    low = {(t or "").lower() for t in texts}
    holds = {t: set(re.findall(r"[a-z]+@x\.org", t)) for t in low}
    terms = {t: set(re.findall("[a-z]{3,}", t)) for t in low}
    n_c = collections.Counter(e for t in low for e in holds[t])
    n_t = collections.Counter(w for t in low for w in terms[t])
    n_ct = collections.Counter((e, w) for t in low for e in holds[t] for w in terms[t])
    n = len(low)
    passed = {
        (e, w) for (e, w), k in n_ct.items()
        if k >= together and math.log2(n * _least_share(k, n_c[e]) / n_t[w]) >= threshold * math.log2(n / n_c[e]) - 1e-12
    }
    assert passed
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find_spans(df, threshold=threshold, min_together=together).collect():
        t = texts[r.doc_id] or ""
        want = {w for e in holds[t.lower()] for w in terms[t.lower()] if (e, w) in passed}
        base = [(s.start, s.end) for s in r.base]
        at = {(m.start(), m.end()) for m in re.finditer("[a-z]{3,}", t.lower()) if m[0] in want}
        at = {(a, b) for a, b in at if not any(a < y and x < b for x, y in base)}
        assert {(s.start, s.end) for s in r.spans if s.kind == pii.TERM} == at, r.doc_id
        if r.doc_id in (0, 200):  # seen with its entity in one text only
            assert ("unheardof" in want) == (together == 1)


def test_pii_terms_beside_base_spans(spark):
    """Random spans: the terms that overlap no base span, in order."""
    rng = random.Random(13)
    rows = []
    for i in range(60):
        base = sorted({(a := rng.randint(0, 900), o := rng.randint(0, 3), a + rng.randint(1, 30), pii.KINDS[o], "v") for _ in range(rng.randint(0, 40))})
        own, at = [], 0
        while rng.random() < 0.99 and at < 900:
            at += rng.randint(0, 9)
            own.append((at, 4, at + rng.randint(3, 9), pii.TERM, "w"))
            at = own[-1][2]
        rows.append((i, base, own))
    df = spark.createDataFrame(rows, f"id int, base array<{pii._SPAN}>, own array<{pii._SPAN}>")
    got = {r.id: [tuple(s) for s in r.s] for r in df.select("id", pii.with_terms(F.col("base"), F.col("own")).alias("s")).collect()}
    for i, base, own in rows:
        free = [t for t in own if not any(t[0] < b[2] and b[0] < t[2] for b in base)]
        assert got[i] == sorted(base + free)


def test_pii_many_spans_in_one_text(spark):
    """Blocks of matches: positions run on, and the time in proportion."""
    times = {}
    for n in (2_000, 5_000, 20_000):
        text = " ".join(f"user{i}@mail{i % 7}.example.org and" for i in range(n))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        began = time.perf_counter()
        (row,) = pii.base_spans(df).select("spans").collect()
        times[n] = time.perf_counter() - began
        assert [(s.start, s.end) for s in row.spans] == [m.span() for m in re.finditer(r"\S+@\S+", text)]
    assert times[20_000] < 10 * times[5_000] + 2


def test_byte_bpe_quality_and_pages(spark, docs, rows, none):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    got = byte_bpe.encode_documents(docs, path, public_tokenizers.PATTERN, keep_ids=True).collect()
    assert collections.Counter((r.doc_id, r.decoded) for r in got) == collections.Counter((d, t or "") for d, t, *_ in rows)
    assert all(r.n_tokens == len(r.ids) for r in got)
    assert byte_bpe.encode_documents(none, path, public_tokenizers.PATTERN).count() == 0
    labels = spark.createDataFrame([(0, 1), (1000, 0), (1000, 1), (None, 0), (2000, None), (3000, 0)], "doc_id long, quality int")
    weights = quality.learn_weights(docs, labels)
    scored = quality.score_documents(docs, weights).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)
    unlearned = quality.learn_weights(docs, labels.limit(0))
    assert {r.score for r in quality.score_documents(docs, unlearned).collect()} == {0.5}
    assert quality.score_documents(none, weights).count() == 0
    pages = spark.createDataFrame(
        [(1, "u", "<article><p>Some text here.</p></article>"), (1, None, None), (None, "u", "")], "page_id long, url string, html string"
    )
    assert sorted(r.n_chars for r in html_mincut.extract_pages(pages).collect()) == [0, 0, 15]
