"""The corpus pipeline against a plain-Python version, and the entry's guard."""

import collections
import math
import os
import random
import subprocess
import sys

import corpus_pipeline as P
import pyarrow as pa
import pyarrow.parquet as pq
import public_tokenizers
from helpers import awkward, brute_base, brute_components, brute_lines, docs, in_order, sha, words
from tokenizers import Tokenizer

from tessera.llm import mixing as M

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_pipeline_matches_brute_force(spark, tmp_path):
    rng = random.Random(12)
    vocab = [f"w{k}" for k in range(80)]
    rows = [(k, "Shared line\n" + " ".join(rng.choices(vocab, k=rng.randint(10, 50)))) for k in range(60)]
    rows += [(100 + k, rows[k][1].replace("w1 ", "v1 ")) for k in range(20)] + [(200 + k, "same again " * 30) for k in range(3)]
    rows += [(i, t) for i, t in awkward() if i is not None]
    ids, texts = zip(*rows)
    n = len(rows)
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()),
                             "lang": pa.array(["en"] * n), "source": pa.array(["s"] * n),
                             "n_chars": pa.array([len(t or "") for t in texts], pa.int64())}), f"{tmp_path}/documents.parquet")
    pq.write_table(pa.table({"doc_id": pa.array([1], pa.int64()), "quality": pa.array([1], pa.int32()),
                             "toxic": pa.array([0], pa.int32())}), f"{tmp_path}/labels.parquet")
    kept = [(i, t) for i, t in rows if not brute_base(t)[-1]]
    kept = [(i, t) for i, _, _, t in brute_lines(kept, 10)]
    sized, group = brute_components(kept)
    first, out = {}, []
    for (i, t), (_, size, _), g in zip(kept, sized, group):
        if not size:
            out.append((i, t))
        elif g not in first or i < first[g][0]:
            first[g] = (i, t)
    out += first.values()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, t in out:
        e = tokenizer.encode(t, add_special_tokens=False).ids
        want.append((i, len(e), sha(tokenizer.decode(e, skip_special_tokens=False))))
    got = P.run(spark, str(tmp_path)).collect()
    assert in_order((r.doc_id, r.n_tokens, r.decoded_sha256) for r in got) == in_order(want)


def test_pipeline_with_certified_cutoffs_sources_and_null_ids(spark, tmp_path):
    """A certified rule rejects junk that the base rules pass; small sources are repeated as the mix says; null ids take part in all stages."""
    rng = random.Random(21)
    vocab = [f"w{k}" for k in range(3000)]
    text = lambda n=40: " ".join(rng.choices(vocab, k=n))
    rows = [(k, "A header of many\n" + text(), ("big", "big", "big", "big", "mid", None)[k % 6]) for k in range(1600)]
    rows += [(3000 + k, " ".join(w + "##" for w in text().split(" ")), "big") for k in range(60)]  # junk
    rows += [(None, text(), ("big", "mid")[k % 2]) for k in range(12)]
    near = [text() for _ in range(4)]
    rows += [(i, t + x, "mid") for t in near for i, x in ((None, " tail"), (5000 + near.index(t), ""), (6000 + near.index(t), " end"))]
    rows += [(None, "same again " * 30, "big")]
    ids, texts, sources = zip(*rows)
    n = len(rows)
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()), "lang": pa.array(["xx"] * n),
                             "source": pa.array(sources, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}),
                   f"{tmp_path}/documents.parquet")
    labelled = [(i, int(i < 3000 or i >= 5000)) for i in ids if i is not None]
    pq.write_table(pa.table({"doc_id": pa.array([i for i, _ in labelled], pa.int64()), "quality": pa.array([q for _, q in labelled], pa.int32()),
                             "toxic": pa.array([0] * len(labelled), pa.int32())}), f"{tmp_path}/labels.parquet")

    kept = [(i, t, s) for i, t, s in rows if not brute_base(t)[-1] and "##" not in t]
    kept = [(i, t, s) for (i, _, s), (_, _, _, t) in zip(kept, brute_lines([r[:2] for r in kept], 10))]
    sized, group = brute_components([r[:2] for r in kept])
    first = {}
    for (i, t, s), g in zip(kept, group):
        if g not in first or (i is None, i or 0) < (first[g][0] is None, first[g][0] or 0):
            first[g] = (i, t, s)
    assert all(size for _, size, _ in sized) and len(first) == 1600 + 12 + 4
    tokens = {}
    for _, t, s in first.values():
        tokens[s] = tokens.get(s, 0) + len(words(t))
    names = sorted(tokens, key=lambda s: (s is None, s or ""))
    sums = [tokens[s] for s in names]
    often = dict(zip(names, M.passes(sums, M.weights(sums, M.solve_exponent(sums, M.TARGET_ENTROPY, M.MAX_REPEATS, None)), None)))
    assert often["big"] < 1.001 and often["mid"] > 1.2

    got = collections.Counter((r.doc_id, r.decoded_sha256) for r in P.run(spark, str(tmp_path)).collect())
    assert set(got) == {(i, sha(t)) for i, t, _ in first.values()}
    out = dict.fromkeys(names, 0)
    for i, t, s in first.values():
        times = got[i, sha(t)]
        assert max(1, math.floor(often[s] - 1e-6)) <= times <= math.ceil(often[s] - 1e-6)
        out[s] += times * len(words(t))
    for s in names:  # up to a cell of the last pass
        assert often[s] * tokens[s] * 0.97 - 100 <= out[s] <= often[s] * tokens[s] + 1e-6


def test_stages_keep_columns(spark):
    table = docs(spark, awkward(), clashing=True)
    for name, stage in P.STAGES[:-1]:
        got = stage(spark, table, "/root/testdata/sf0.001")
        assert got.columns == table.columns, name
        got.count()
    assert len(P.STAGES) == 5


def test_empty_documents(spark):
    for _, stage in P.STAGES:
        assert stage(spark, docs(spark, []), "/root/testdata/sf0.001").count() == 0


def test_entry_without_the_operators(tmp_path):
    """Without corpus_pipeline.py and the llm folder the entry imports and keeps its other queries."""
    for name in ("__spark_entry__.py", "tessera"):
        os.symlink(os.path.join(ROOT, name), tmp_path / name) if name.endswith(".py") else None
    (tmp_path / "tessera").mkdir()
    for name in os.listdir(os.path.join(ROOT, "tessera")):
        if name not in ("llm", "__pycache__"):
            os.symlink(os.path.join(ROOT, "tessera", name), tmp_path / "tessera" / name)
    code = ("import importlib.util as u, sys; sys.path.insert(0, '.'); s = u.spec_from_file_location('e', '__spark_entry__.py')\n"
            "src = open('__spark_entry__.py').read().replace('os.path.abspath(__file__)', repr('" + str(tmp_path) + "/x'))\n"
            "ns = {'__file__': '__spark_entry__.py'}; exec(compile(src, 'e', 'exec'), ns)\n"
            "q = ns['queries'](); assert q and not any(k.startswith('op') and k[2].isdigit() or k == 'pipeline' for k in q); print(len(q))")
    got = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert got.returncode == 0, got.stderr
    assert int(got.stdout) > 50
