"""Token counts against the tokenizer itself on whole texts."""

from __future__ import annotations

import public_tokenizers
import pytest
import sentencepiece

from unitmesh.llm.token_counts import count_tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def slow(pairs):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    counts = [(i, len((t or "").encode()), len(sp.encode(t or ""))) for i, t in pairs]
    return sorted(((i, b, n, n > 4096) for i, b, n in counts), key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()), key=str)


@pytest.mark.parametrize("head", [400_000, 50, 0])
def test_whole_table_at_any_head_size(docs_of, corpus, head):
    assert result(count_tokens(docs_of(corpus), MODEL, head_rows=head)) == slow(corpus)


def test_edges(docs_of):
    pairs = [(1, None), (2, ""), (3, " "), (4, "   "), (5, " a"), (6, "a "), (7, "a  b   c"), (8, "\n\n a\tb"),
             (9, "<s> </s> <unk> <0x0A>"), (10, "a▁b ▁▁"), (11, "漢字仮名 😀 ½ﬁ 　x"), (None, "x y"), (None, "x y"),
             (12, "\x00"), (13, "long " * 30000), (14, "n" * 20000)]
    df = docs_of(pairs, n_tokens="mine", _token=1)
    assert result(count_tokens(df, MODEL, head_rows=3)) == slow(pairs)
    assert result(count_tokens(docs_of([]), MODEL)) == []
