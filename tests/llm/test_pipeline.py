"""The stages of the corpus pipeline, one after the other, against plain versions on
each stage's own input; and the corpus queries against their SQL."""

import collections
import hashlib
import re

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SF001
from tests.oracle_compare import compare, duck
from tidemark.llm import quality, queries, simhash
from tidemark.sources.tables import table


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    res = compare(spark, duck(SF001), name, entry.queries()[name], queries.ORACLE_SQL[name], SF001)
    assert res["match"], res


def _rows(df):
    return collections.Counter((r.doc_id, r.text, r.lang, r.source) for r in df.collect())


def _good(spark, rows):
    docs = table(spark, SF001, "documents")
    weights = quality.learn_weights(docs, table(spark, SF001, "labels"))
    return collections.Counter({r: n for r, n in rows.items() if quality.score_text(r[1] or "", weights) >= 0.5})


def _without_copies(spark, rows):
    groups = collections.defaultdict(list)
    for r in rows.elements():
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append(r)
    return collections.Counter(min(g, key=lambda r: (-len(r[1] or ""), r[0])) for g in groups.values())


def _without_near_copies(spark, rows):
    rows = sorted(rows.elements(), key=lambda r: r[0])
    prints = [simhash.fingerprint(r[1] or "") % (1 << 64) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a  # rows stand in the order of their ids
    return collections.Counter(r for i, r in enumerate(rows) if find(i) == i)


def _mixed(spark, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", [list(r) for r in rows.elements()])
    sql = queries.ORACLE_SQL["op7_mixing"]
    copies = dict(con.execute(f"SELECT doc_id, copies FROM ({sql})").fetchall())
    return collections.Counter({r: copies[r[0]] for r in rows if r[0] in copies})


def test_stages_equal_plain_versions(spark):
    """Ids are unique in the documents, so a row is told by its id."""
    plain = [_good, _without_copies, _without_near_copies, _mixed]
    docs = table(spark, SF001, "documents")
    for (name, stage), check in zip(corpus_pipeline.STAGES, plain):
        before = _rows(docs)
        out = corpus_pipeline.materialise(stage(spark, docs, SF001), f"test-{name}")
        assert out.columns == docs.columns
        after = _rows(out)
        assert after == check(spark, before), name
        assert after, name
        docs = out

    import public_tokenizers
    import tiktoken

    tokens = queries.byte_bpe.read_ranks(spark, public_tokenizers.path(queries.VOCABULARY))
    plain_bpe = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    want = collections.Counter()
    for (doc_id, text, _, _), n in _rows(docs).items():
        ids = plain_bpe.encode_ordinary(text or "")
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        want[doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += n
    got = corpus_pipeline.STAGES[-1][1](spark, docs, SF001).collect()
    assert collections.Counter(map(tuple, got)) == want
    whole = corpus_pipeline.run(spark, SF001).collect()
    assert collections.Counter(map(tuple, whole)) == want
