"""Line deduplication against a plain Python version."""

from __future__ import annotations

from collections import defaultdict

from unitmesh.llm.line_dedup import dedup_lines

EDGE = " \t\n\x0b\x0c\r"
LONG = "This line is certainly longer than forty characters, is it not"


def slow(pairs):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(EDGE))
    holders = defaultdict(set)
    for i, t in pairs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(i)
    out = []
    for i, t in pairs:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            ids = holders.get(key(line), ())
            if len(ids) < 5 or i == max((x for x in ids if x is not None), default=None):
                kept.append(line)
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in df.collect()), key=str)


def test_whole_table(docs_of, corpus):
    assert result(dedup_lines(docs_of(corpus))) == slow(corpus)


def test_edges_nulls_repeats_and_clashes(docs_of):
    pairs = [(i, f"head {i}\n  {LONG.upper() if i % 2 else LONG}\t\r\n{LONG}\ntail") for i in range(5)]
    pairs += [(None, LONG), (None, LONG), (3, LONG), (9, None), (10, ""), (11, "\n\n"), (12, ("é" * 40 + "\n") * 3)]
    pairs += [(20 + i, "É" * 40) for i in range(5)] + [(30 + i, "é" * 39) for i in range(6)] + [(40 + i, "\n".join(["x" * 50] * 2000)) for i in range(5)]
    df = docs_of(pairs, n_lines="mine", _hash=1, _id="a")
    out = dedup_lines(df)
    assert result(out) == slow(pairs)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "_hash", "_id", "n_lines", "n_dropped"]
    assert dedup_lines(df, report=False).columns == df.columns
    assert dedup_lines(df, report=False).where("n_lines = 'mine'").count() == len(pairs)
    assert result(dedup_lines(docs_of([]))) == []
