"""Archives, vector search and the whole pipeline against plain versions."""

import gzip
import hashlib
import io
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import check_queries
import corpus_pipeline
from inundation.llm import pieces, pu_quality, queries, secret_ledger, shared, simhash, topk, warc

PAGES = [
    (3, "u3", "x" * 200), (1, "u1", "x" * 200), (2, None, "x" * 200), (4, "u4", "short"), (5, "u5", "short"), (6, "u\r\n6", None), (7, "u7", ""),
    (8, "u8", "é" * 50), (9, "u9", "é" * 50), (10, "u10", "é" * 49), (11, "u11", "é" * 49), (12, "u12", "WARC/1.1\r\n\r\n" * 50_000),
    (None, "u0", "y" * 100), (13, "u13", "y" * 100), (14, "u14", "z" * 99), (15, "u15", "z" * 99),
]


def archive(spark, df, folder):
    records = warc.with_revisits(df, "page_id", "html", "url")
    written = shared.keep(warc.write_monolithic(records, f"{folder}/crawl"), "archives")
    index = shared.keep(warc.normalise(written, f"{folder}/crawl", f"{folder}/records"), "index")
    return written, index


@pytest.fixture(scope="module")
def archived(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("warc")
    df = spark.createDataFrame([(*r, "clash") for r in PAGES], "page_id long, url string, html string, digest string")
    return (folder, *archive(spark, df, folder))


def test_warc_records(spark, archived):
    folder, written, index = archived
    read = warc.read_records(warc.read_index(spark, f"{folder}/records"), str(folder / "records")).collect()
    assert len(read) == len(PAGES) == index.count() == written.agg(F.sum("n_records")).first()[0]
    first = {}
    for i, _, html in sorted(PAGES, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(html or "", i)
    for r in read:
        html = next(h or "" for i, _, h in PAGES if i == r.page_id)
        raw = html.encode()
        revisit = len(raw) >= 100 and first[html] != r.page_id
        assert (r.payload_bytes, r.payload_digest, r.intact) == (len(raw), hashlib.sha256(raw).hexdigest(), True)
        assert (r.record_type, r.refers_to) == (("revisit", first[html]) if revisit else ("response", None))
        assert (None if r.payload is None else bytes(r.payload)) == (None if revisit else raw)


def test_warc_revisits_are_proven_by_their_response(spark, archived):
    folder, *_ = archived
    read = warc.read_records(warc.read_index(spark, f"{folder}/records"), str(folder / "records"))
    got = {r.page_id: r for r in warc.resolve_revisits(read).collect()}
    first = {}
    for i, _, html in sorted(PAGES, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(html or "", i)
    assert len(got) == len(PAGES) and all(r.intact for r in got.values())
    for i, _, html in PAGES:
        assert (got[i].payload_bytes, got[i].payload_digest) == (len((html or "").encode()), hashlib.sha256((html or "").encode()).hexdigest())
    # A response of which a byte has changed, one that is cut short, and one that is gone.
    broken = F.col("page_id") == 1
    hurt = read.withColumns({"payload_digest": F.when(broken, F.lit("0" * 64)).otherwise(F.col("payload_digest")), "intact": ~broken & F.col("intact")})
    short = read.withColumn("payload_bytes", F.when(broken, F.col("payload_bytes") - 1).otherwise(F.col("payload_bytes")))
    unsound = read.withColumn("intact", ~broken & F.col("intact"))
    for frame, known in ((hurt, False), (read.where(~broken), False), (short, True), (unsound, True)):
        found = {r.page_id: r for r in warc.resolve_revisits(frame).collect()}
        assert [found[i].intact for i in (2, 3)] == [False, False] and found[9].intact
        assert (found[2].payload_bytes is not None) == known == (found[2].payload_digest is not None)
    assert warc.resolve_revisits(read.limit(0)).count() == 0


def test_warc_members_stand_alone_and_join_to_the_same_stream(archived):
    folder, written, index = archived
    for r in written.collect():
        mono, norm = ((folder / d / r.archive).read_bytes() for d in ("crawl", "records"))
        assert gzip.decompress(mono) == gzip.decompress(norm)
        # The first is one member to its end, the second has one per record.
        d = zlib.decompressobj(warc.GZIP)
        d.decompress(mono)
        assert d.eof and not d.unused_data
        own = sorted((x.offset, x.length) for x in index.where(F.col("archive") == r.archive).collect())
        assert [a + n for a, n in own] == [a for a, _ in own[1:]] + [len(norm)]
        for a, n in own:
            assert gzip.decompress(norm[a : a + n]).startswith(warc.VERSION)


def test_warc_streams_of_any_shape():
    record = warc.record_bytes("i", 1, "u", b"p" * 3000, "d", None, False)
    many = b"".join(gzip.compress(record) for _ in range(3))
    for raw in (many, gzip.compress(record * 3)):
        assert [len(r) for _, r in warc.split_records(warc.read_stream(io.BytesIO(raw)))] == [len(record)] * 3
    assert list(warc.split_records(warc.read_stream(io.BytesIO(b"")))) == []
    with pytest.raises(ValueError):
        list(warc.split_records(iter([record[:-9]])))
    with pytest.raises(ValueError):
        list(warc.split_records(iter([b"no record\r\n\r\n"])))


def test_shuffled_payloads_are_gone_before_archives_are_rewritten(spark, monkeypatch):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {f for f in (str(files.getAllFiles().apply(i)) for i in range(files.getAllFiles().size())) if "shuffle_" in f and f.endswith(".data")}
    before, left, rewrite = shuffled(), [], warc.normalise

    def normalise(*args):
        left.append(shuffled() - before)
        return rewrite(*args)

    monkeypatch.setattr(warc, "normalise", normalise)
    assert queries.op6_warc(spark, "/root/testdata/sf0.001").count() > 0
    assert left == [set()]
    assert spark.conf.get(shared.RELEASE) == "false"


def test_warc_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    _, index = archive(spark, df, tmp_path)
    assert index.collect() == [] and warc.read_records(warc.read_index(spark, f"{tmp_path}/records"), f"{tmp_path}/records").collect() == []


# --- top k ----------------------------------------------------------------------------------------------------------


def plain_top(vectors, is_query, k):
    rows = sorted({(i, tuple(np.floor(256 * np.array(v, np.float32).astype(float)))) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)})
    out = set()
    for qi in sorted({i for i, _ in rows if is_query(i)}):
        found = set()
        for i, q in rows:
            if i == qi:
                found |= {(-sum(a * b for a, b in zip(q, v)), j) for j, v in rows if j != qi}
        out |= {(qi, n + 1, j, int(-s)) for n, (s, j) in enumerate(sorted(found)[:k])}
    return sorted(out)


def vectors(rng, n, dim=6):
    return [(i, [float(x) for x in np.float32(rng.normal(0, 1, dim))]) for i in range(n)]


@pytest.mark.parametrize("how", [{}, {"range_rows": 7, "group_rows": 2}, {"k": 1, "range_rows": 100}, {"k": 500}])
def test_top_k(spark, how):
    rng = np.random.default_rng(4)
    rows = vectors(rng, 150)
    rows += [(1000 + i, rows[7][1]) for i in range(9)] + [(200, None), (201, [1.0, None]), (202, [float("nan")]), (203, [float("inf")]), (None, [1.0] * 6), (205, []), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"id": F.lit("clash"), "v": F.lit(0), "number": F.lit(1)})
    got = topk.top_k(df, F.col("id") % 50 == 0, **how).select("query_id", "rank", "vec_id", "score")
    assert sorted(map(tuple, got.collect())) == plain_top(rows, lambda i: i % 50 == 0, how.get("k", topk.K))


def test_top_k_of_repeated_ids_with_equal_scores(spark, tmp_path):
    """Ids with other values and the same score, as candidates and as queries, are rows of their own as in the SQL."""
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (50, [1.0, 0.25])]
    rows += [(1, [0.75, 0.5]), (1, [0.75, -0.5])] + [(i, [0.5 - i / 64, 0.0]) for i in range(2, 9)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(f"{tmp_path}/written")
    next((tmp_path / "written").glob("*.parquet")).rename(tmp_path / "embeddings.parquet")
    got = queries.op10_topk(spark, str(tmp_path)).collect()
    assert [r.rank for r in sorted(got)] == [1, 2, 3, 4, 5] * 2
    assert check_queries.compare(spark, check_queries.duck(str(tmp_path)), "op10_topk", str(tmp_path))[0]


def test_top_k_of_few_and_none(spark):
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(one, F.col("id") % 50 == 0).collect() == [] and topk.top_k(one.limit(0), F.lit(True)).collect() == []
    two = spark.createDataFrame([(0, [1.0]), (1, [0.5])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(two, F.col("id") % 50 == 0).collect()] == [(0, 1, 1, 256 * 128)]


def test_blocks_below_the_kth_score_are_not_scored():
    v = np.concatenate([np.full((64, 2), 9.0), np.zeros((640, 2))])
    found, scored = topk.search_range(np.array([-1]), np.array([[1.0, 1.0]]), np.array([-np.inf]), np.arange(len(v)), v, 5)
    assert scored == 1 and [f[2] for f in found] == [0, 1, 2, 3, 4]


# --- pipeline -------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def stages(spark):
    d = "/root/testdata/sf0.001"
    out = [spark.read.parquet(f"{d}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(shared.keep(stage(spark, out[-1], d), "test-" + name.split()[0]))
    return out


def test_stages_keep_the_columns_of_documents(stages):
    for df in stages[:-1]:
        assert df.columns == corpus_pipeline.COLUMNS
    assert stages[-1].columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "round_trip", "token_ids"]


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_do_what_their_operators_say(spark, stages):
    d = "/root/testdata/sf0.001"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    assert ids(stages[1]) == ids(pu_quality.classify(stages[0], labels).where("predicted = 1"))
    assert ids(stages[2]) == sorted({r.component_id for r in simhash.near_duplicates(stages[1]).collect()})
    assert ids(stages[3]) == ids(stages[2])
    ledger = secret_ledger.update_ledger(stages[3], shared.new_folder(spark, "clean"))
    assert secret_ledger.findings_by_path(stages[3], ledger).where("size(findings) > 0").count() == 0
    assert stages[3].where("n_chars <> length(text)").count() == 0
    assert set(ids(stages[4])) <= set(ids(stages[3]))
    back = pieces.decode(stages[5], pieces.read_vocabulary(corpus_pipeline.PIECE_MODEL)).select("doc_id", "text")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, stages[4].select("doc_id", "text").collect()))


def test_run_equals_its_stages(spark, stages):
    whole = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert sorted(map(str, whole.collect())) == sorted(map(str, stages[-1].collect()))


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_odd_and_empty_tables(spark, stage):
    d = "/root/testdata/sf0.001"
    schema = "doc_id long, text string, lang string, source string, n_chars long, id string, blob string, copy string"
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some text", "en", "s", 9), (3, "w " * 20_000, "en", "t", 40_000)]
    odd += [(4, "token=abcdefghijklmnop here", "en", "s", 27)] * 2
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in odd], schema)
    name, run = corpus_pipeline.STAGES[stage]
    run(spark, df, d).collect()
    assert run(spark, df.limit(0), d).collect() == []


def test_every_operator_has_its_query():
    names = sorted(queries.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names} == {"pipeline", *(f"op{i}" for i in range(1, 14))}
