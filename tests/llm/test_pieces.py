"""The agenda of symbol pairs against the sentencepiece library."""

import public_tokenizers
import pytest
import sentencepiece
from helpers import awkward, docs, in_order, rows_of, sha
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import pieces as P
from tessera.llm import queries
from tessera.llm.bpe import packed

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def brute(rows, library):
    out = []
    for i, t in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        out.append((i, len(ids), sha(packed(ids)), sha(library.decode(ids))))
    return out


PARTS = st.sampled_from([*"abcdeinst", "the", "ing", " ", "  ", "    ", "\n", "\t", "▁", "é", "é", "漢", "字", "🙂", "\x00", "​",
                         "<s>", "</s>", "<unk>", "<0x0A>", "123", "...", "//", "\r\n", "aaaa"])


@settings(max_examples=500, deadline=None)
@given(st.lists(PARTS, max_size=60))
def test_encode(parts):
    p, text = P.pieces(PATH), "".join(parts)
    ids = p.encode(text)
    assert ids == p.library.encode(text, add_bos=True, add_eos=True) and p.decode(ids) == p.library.decode(ids)


@settings(max_examples=500, deadline=None)
@given(st.text(max_size=80))
def test_encode_any_text(text):
    p = P.pieces(PATH)
    assert p.encode(text) == p.library.encode(text, add_bos=True, add_eos=True)


@settings(max_examples=800, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 400), st.sampled_from([1, 2, 29871, 233, 191, 165, 198, 172]), st.integers(0, 31999)), max_size=14))
def test_decode_any_ids(ids):
    p = P.pieces(PATH)
    assert p.decode(ids) == p.library.decode(ids)


@pytest.mark.parametrize("text", ["a" * 30_000, "ab " * 30_000, "漢字" * 10_000, " " * 20_000, "z9" * 9_999, "é\n" * 5_000])
def test_long_texts(text, library):
    p = P.Pieces(PATH)
    assert p.encode(text) == library.encode(text, add_bos=True, add_eos=True)


def test_forgetting(library, monkeypatch):
    """More distinct parts than are remembered."""
    monkeypatch.setattr(P, "KNOWN_WORDS", 250)
    p = P.Pieces(PATH)
    texts = [" ".join(f"word{k}x" for k in range(lo, lo + 90)) + " " + "y" * lo for lo in (0, 60, 120, 60, 0)]
    for k in range(0, 5, 2):
        assert p.encode_batch(texts[k:k + 2]) == [packed(i) for i in library.encode(texts[k:k + 2], add_bos=True, add_eos=True)]
        assert len(p.known) <= 250 and max(map(len, p.known)) <= P.KNOWN_CHARS


def test_agendas_side_by_side_equal_the_heap():
    """Rows of the array and the heap merge alike, foreign characters and equal scores included."""
    import random
    p, rng = P.pieces(PATH), random.Random(7)
    words = ["".join(rng.choices("aeinrst▁  the漢🙂\n", k=rng.randint(1, 40))).replace(" ", P.SPACE) for _ in range(3000)]
    words = [P.SPACE + w for w in words]
    assert p.agendas(words, 42) == [packed(p.part(w)) for w in words]


def test_models_whose_pieces_reach_across_spaces(library, monkeypatch):
    """Without cuts at spaces a whole text goes through the heap."""
    p = P.Pieces(PATH)
    p.words = None
    texts = ["the quick  brown fox\n", "", " x "]
    assert p.encode_batch(texts) == [packed(i) for i in library.encode(texts, add_bos=True, add_eos=True)]


@pytest.mark.parametrize("rows", [awkward(), [], [(1, None)]])
def test_documents(spark, library, rows):
    got = P.piece_digests(docs(spark, rows, clashing=True), PATH)
    assert rows_of(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == in_order(brute(rows, library))
    assert all(r.agrees for r in got.collect())
    assert "agrees" not in P.piece_encode_decode(docs(spark, rows), PATH, check=False).columns


def test_query_over_whole_table(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op12_piece_encode_decode(spark, sf_dir)
    assert rows_of(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == in_order(brute(rows, library))
