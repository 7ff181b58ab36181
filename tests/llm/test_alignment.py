"""Cross-tokenizer alignment against a plain walk over both token sequences."""

import collections

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from helpers import awkward, docs, in_order, rows_of, sha
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import alignment as A
from tessera.llm import queries
from tessera.llm.bpe import byte_characters

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def walk(text, a_tool, b_tool, chars=byte_characters()):
    """(A ids, B ids, links, groups) of one text, by two hands that move along its bytes."""
    whole = (" " + text).encode()
    a, b = (a_tool.encode(" " + text, add_special_tokens=False).ids, b_tool.encode(text)) if text else ([], [])
    a_bytes = [bytes(chars[c] for c in a_tool.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(p[1:-1], 16)]) if b_tool.is_byte(i) else p.replace("▁", " ").encode()
               for i, p in ((i, b_tool.id_to_piece(i)) for i in b)]
    links, groups = collections.Counter(), []
    if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return [], [], links, groups
    i = j = 0
    ends = [len(a_bytes[0]), len(b_bytes[0])]
    here = ([], [])
    while True:
        links[a[i], b[j]] += 1
        if ends[0] <= ends[1]:
            here[0].append(a[i])
        if ends[1] <= ends[0]:
            here[1].append(b[j])
        if ends[0] == ends[1]:
            groups.append("|".join(",".join(map(str, side)) for side in here))
            here = ([], [])
            i, j = i + 1, j + 1
            if i == len(a):
                return a, b, links, groups
            ends = [ends[0] + len(a_bytes[i]), ends[1] + len(b_bytes[j])]
        elif ends[0] < ends[1]:
            i += 1
            ends[0] += len(a_bytes[i])
        else:
            j += 1
            ends[1] += len(b_bytes[j])


def brute(rows):
    a_tool, b_tool = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_tool.encode_special_tokens = True
    walked = [(i, *walk(t or "", a_tool, b_tool)) for i, t in rows]
    count = sum((w[3] for w in walked), collections.Counter())
    held = collections.Counter(p for w in walked for p in w[3])
    top = collections.defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    out = [(i, len(a), len(b), len(groups), sum(links.values()), sum(n for p, n in links.items() if count[p] == top[p[1]]),
            sum(n * count[p] for p, n in links.items()), sha(";".join(groups)) if groups else "")
           for i, a, b, links, groups in walked]
    pairs = [(a, b, held[a, b], n, n == top[b]) for (a, b), n in count.items()]
    return out, pairs, [(i, ";".join(groups)) for i, *_, groups in walked]


HARD = [(20, "naïve Ünïcode 日本語 😀​"), (21, "a▁b"), (22, "<s> <unk> </s> <0x41> <|endoftext|>"), (23, " leading"),
        (24, "trailing "), (25, "\n\n\t  x"), (26, "    "), (27, "é" * 50), (28, "the the the the the the the the the")]


@pytest.mark.parametrize("run_links, chunk_docs", [(A.RUN_LINKS, A.CHUNK), (50, 7), (1, 1), (200, 1000)])
def test_alignment(spark, run_links, chunk_docs):
    """Texts, pairs and scores; runs that end within a chunk are OR-ed together."""
    rows = awkward() + HARD + [(100 + k, "the quick brown fox jumps " * (k % 3)) for k in range(40)]
    want, pairs, _ = brute(rows)
    table = docs(spark, rows, clashing=True)
    got = A.alignment_scores(table, BYTES, PIECES, run_links=run_links, chunk_docs=chunk_docs)
    assert rows_of(got, *COLUMNS) == in_order(want)
    _, containers = A.inverted_bitmaps(table, BYTES, PIECES, run_links=run_links, chunk_docs=chunk_docs)
    assert containers.groupBy(*A.CONTAINER[:-1]).count().where("count > 1").isEmpty()
    assert rows_of(A.pair_counts(containers), "a", "b", "n_docs", "n_links", "best") == sorted(pairs)


def test_groups_as_text(spark):
    rows = awkward() + HARD
    assert rows_of(A.alignments(docs(spark, rows), BYTES, PIECES), "doc_id", "groups") == in_order(brute(rows)[2])


def test_alignment_of_nothing(spark):
    for rows in ([], [(1, None)], [(1, ""), (1, "")]):
        got = A.alignment_scores(docs(spark, rows), BYTES, PIECES)
        assert rows_of(got, *COLUMNS) == [(i, 0, 0, 0, 0, 0, 0, "") for i, _ in rows]


@pytest.mark.parametrize("share", [0.0001, 0.05, 0.07, 0.5, 1.0])
def test_containers(share):
    """Lists below 4,096 documents, bitmaps from there on; both are read back."""
    rng = np.random.default_rng(int(share * 1e4))
    lists = [np.flatnonzero(rng.random(A.CHUNK) < s) for s in (share, 0.001, share, 0.2)]
    lists = [x if len(x) else np.array([5]) for x in lists]
    starts = np.cumsum([0, *map(len, lists)])[:-1]
    docs_ = A._packed(starts, np.concatenate(lists))
    counts, low = A.unpacked(docs_)
    assert counts.tolist() == [len(x) for x in lists] and low.tolist() == np.concatenate(lists).tolist()
    assert all(len(x.as_py()) == (A.BITMAP_BYTES if len(y) >= A.DENSE else 2 * len(y)) for x, y in zip(docs_, lists))
    counts, low = A.unpacked(docs_.slice(1, 2))
    assert low.tolist() == np.concatenate(lists[1:3]).tolist()


def test_union_across_batches():
    """Containers of one key are OR-ed, also where an Arrow batch ends between them."""
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for key in range(30):
        whole = set()
        for part in range(1 + key % 4):
            low = np.flatnonzero(rng.random(A.CHUNK) < (0.05 if key % 5 == 0 else 0.0002))
            low = low if len(low) else np.array([part])
            whole |= set(low.tolist())
            rows.append((key // 10, key // 3, key, -1, A._packed(np.array([0]), low)[0].as_py()))
        want[key] = sorted(whole)
    cols = {c: pa.array(v, A.FIELDS.field(c).type) for c, v in zip(A.CONTAINER, zip(*rows))}
    t = pa.table(cols)
    for size in (1, 3, 1000):
        out = pa.Table.from_batches(list(A._or(iter(t.to_batches(max_chunksize=size)))))
        got = {b: A.unpacked(pa.array([d], pa.binary()))[1].tolist() for b, d in zip(out["b"].to_pylist(), out["docs"].to_pylist())}
        assert out.num_rows == 30 and got == want


def test_popcount(spark):
    low = np.arange(0, A.CHUNK, 3)
    rows = [(3, A._packed(np.array([0]), low)[0].as_py(), len(low)), (-1, A._packed(np.array([0]), low[:7])[0].as_py(), 7)]
    df = spark.createDataFrame(rows, "plane byte, docs binary, n long")
    assert rows_of(df.select("n", A.popcount(F.col("docs")).alias("got"), A.weight(F.col("plane")).alias("w")), "n", "got", "w") \
        == [(7, 7, 1), (len(low), len(low), 8)]


def test_query_over_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(queries.op11_token_alignment(spark, sf_dir), *COLUMNS) == in_order(brute(rows)[0])
