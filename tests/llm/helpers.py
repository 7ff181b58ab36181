"""Small tables with the awkward cases, and plain-Python versions of the contracts."""

import collections
import hashlib
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("id", "key", "row", "h", "n", "text_sha256", "kept", "copy", "dropped", "block", "pass", "label", "digest")


def awkward():
    """(doc_id, text): nulls, empty and blank texts, repeated rows, repeated ids, a long text, ties."""
    base = [(1, "One two three four five six seven eight.\nNext line here\n"), (2, None), (3, ""), (4, " \t\n "),
            (5, "one two three four five six seven eight.\nNext line here\n"), (6, "naïve Ünïcode Straße\r\n日本語 😀"),
            (7, "x" * 70_000), (8, "ab " * 30_000), (9, "<|endoftext|> a<|endoftext|>"), (10, "A"), (11, "a")]
    return base + [(1, base[0][1]), (1, "another text under the same id"), (None, base[0][1]), (None, None), (7, base[6][1])]


def docs(spark, rows, clashing=False):
    full = [(i, t, ("en", "de", None)[k % 3], ("s1", None, "s2")[k % 3], len(t) if t is not None else None)
            for k, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(full, SCHEMA).repartition(4)
    if clashing:
        from pyspark.sql import functions as F
        for k, c in enumerate(CLASHING):
            df = df.withColumn(c, F.lit(k if k % 2 else None).cast("int"))
    return df


def sha(b):
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def rows_of(df, *cols):
    """Rows as sorted tuples; None sorts first."""
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(got, key=lambda r: [(x is not None, x if x is not None else 0) for x in r])


def in_order(rows):
    return sorted(rows, key=lambda r: [(x is not None, x if x is not None else 0) for x in r])


def line_key(line):
    return lower(line.strip(" \t\n\x0b\x0c\r"))


def brute_lines(rows, min_docs):
    seen = collections.Counter()
    for _, t in rows:
        seen.update({line_key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not line_key(x) or seen[line_key(x)] < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def shingles(t):
    w = words(lower(t or ""))
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    """(doc_id, set size, smallest linked doc_id) and the group of each row."""
    sets, up = [shingles(t) for _, t in rows], list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                up[top(a)] = top(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[top(a)] = min(least.get(top(a), i), i)
    return [(i, len(sets[a]), least.get(top(a))) for a, (i, _) in enumerate(rows)], [top(a) for a in range(len(rows))]


def brute_removed(texts, length):
    """Per text (bytes): (size, removed, spans, kept)."""
    seen = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        out.append((len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), bytes(c for c, g in zip(t, gone) if not g)))
    return out


def brute_base(t):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    t = t or ""
    w, seen, cover = words(t), collections.defaultdict(list), set()
    for i in range(len(w) - 7):
        seen[tuple(w[i:i + 8])].append(i)
    for at in seen.values():
        if len(at) > 1:
            cover.update(k for i in at for k in range(i, i + 8))
    lines = [x for x in t.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover),
            len(w) < 20 or 100 * len(cover) > 30 * len(w))
