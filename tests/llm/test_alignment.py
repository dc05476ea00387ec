"""Cross-tokenizer alignment against a plain version of it."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from inundation.llm import lockstep, queries

A_FILE, B_FILE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
ODD = [
    (1, "the quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (4, " "), (5, "  two  spaces \n\n and\ttabs "), (6, "▁mark in it"),
    (7, "<|endoftext|> and <s> </s> <unk> <0x41>"), (8, "Éa ñ 中文 🤦🏼‍♂️ Ünï nbsp　wide"), (9, "a" * 3000), (10, "1234567890" * 50),
    (11, "can't we'll 'tis I'd"), (11, "can't we'll 'tis I'd"), (None, "no id the fox"), (12, "nul\x00 byte"), (13, "中" * 500), (14, "word, " * 2000),
    (15, "x \n y"), (16, "  sep ﬁ ligature"),
]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def both():
    return lockstep.read_tokenizers(A_FILE, B_FILE)


def plain(rows):
    """Whole texts through the libraries, pointers document by document."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    letters = {chr(i): i for i in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    letters |= {chr(256 + k): i for k, i in enumerate(i for i in range(256) if i not in set(letters.values()))}
    show_a = lambda i: bytes(letters[c] for c in a.id_to_token(i))
    show_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    groups, docs_of = [], Counter()
    for _, text in rows:
        out = []
        if text:
            wanted = (" " + text).encode()
            ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            if b"".join(map(show_a, ia)) == wanted == b"".join(map(show_b, ib)):
                ends = [set(np.cumsum([len(f(i)) for i in ids]).tolist()) for f, ids in ((show_a, ia), (show_b, ib))]
                cuts = sorted(ends[0] & ends[1])
                out = [([], []) for _ in cuts]
                for side, f, ids in ((0, show_a, ia), (1, show_b, ib)):
                    at, k = 0, 0
                    for i in ids:
                        out[k][side].append(i)
                        at += len(f(i))
                        k += at == cuts[k]
        groups.append(out)
        docs_of.update({(x, y) for ga, gb in out for x in ga for y in gb})
    best = defaultdict(int)
    for (x, _), n in docs_of.items():
        best[x] = max(best[x], n)
    result = []
    for (i, _), g in zip(rows, groups, strict=True):
        links = [(x, y) for ga, gb in g for x in ga for y in gb]
        text = ";".join(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}" for ga, gb in g)
        result.append(
            (i, sum(len(ga) for ga, _ in g), sum(len(gb) for _, gb in g), len(g), len(links), sum(docs_of[p] == best[p[0]] for p in links),
             sum(docs_of[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if g else "")
        )
    return sorted(result, key=str)


def aligned(df, both, **how):
    return sorted((tuple(r) for r in lockstep.align(df, both, **how).collect()), key=str)


@pytest.mark.parametrize("how", [{}, {"chunk_bytes": 300}])
def test_odd_rows(spark, both, how):
    df = spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit("clash") for c in ("id", "chunk", "pair", "n", "best", "n_a")})
    assert aligned(df, both, **how) == plain(ODD)


def test_documents(spark, both):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted((tuple(r) for r in queries.op12_lockstep(spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == plain([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def test_long_text_and_empty_table(spark, both):
    text = "the fox " * 200_000 + "end"
    assert len(text) > lockstep.SLICE_BYTES
    got = lockstep.align(spark.createDataFrame([(1, text), (2, "the")], SCHEMA), both, chunk_bytes=1 << 16).orderBy("doc_id").collect()
    # ' the' is one token of both and in both documents, ' fox' is two of B.
    assert (got[0].n_a, got[0].n_groups, got[0].n_links, got[0].count_sum) == (400_001, 400_001, 600_001, 800_001)
    assert got[1].count_sum == 2
    assert aligned(spark.createDataFrame([], SCHEMA), both) == []


def test_large_groups_are_multiplied_out_by_their_ids():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 7, 40).astype(np.int32), rng.integers(0, 5, 50).astype(np.int32)
    groups = np.array([[0, 0, 3, 0, 2], [0, 3, 30, 2, 40], [1, 30, 33, 40, 44], [1, 33, 40, 44, 50]]).T
    want = Counter()
    for d, a0, a1, b0, b1 in groups.T:
        want.update(d * 35 + x * 5 + y for x in a[a0:a1] for y in b[b0:b1])
    for most in (1, 4, 12, 40, 2000):
        keys, times = lockstep.document_pairs(groups, a, b, 5, 35, most)
        assert dict(zip(keys.tolist(), times.tolist(), strict=True)) == want and (np.diff(keys) > 0).all()


def test_documents_leave_the_state_when_they_are_through():
    ends_a, ends_b = np.array([2, 5, 6, 1, 2, 3, 4]), np.array([5, 6, 4])
    groups = lockstep.merge(ends_a, np.array([3, 0, 4]), ends_b, np.array([2, 0, 1]))
    assert groups.T.tolist() == [[0, 0, 2, 0, 1], [0, 2, 3, 1, 2], [2, 3, 7, 2, 3]]
