"""The registered token counts against a segmentation of its own: suffixes, from the end of each word on."""

from __future__ import annotations

import math

import sentencepiece
from conftest import SF
from helpers_llm import PIECES, words

from assaylake.llm.queries import QUERIES


def ranked_pieces() -> dict[str, int]:
    """Scores by Zipf's law over the ranks of ordinary pieces, in thousandths."""
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    ordinary = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not any(test(i) for test in special)]
    return {piece: -round(1000 * math.log(rank)) for rank, piece in enumerate(ordinary, 2)}


def fewest_of_best(word: str, pieces: dict[str, int], byte: int) -> int:
    """Pieces in the split with the highest total, of equal ones with the fewest pieces."""
    after = {len(word): (0, 0)}
    for start in reversed(range(len(word))):
        size = len(word[start].encode())
        score, used = after[start + 1]
        choices = [(score + size * byte, used - size)]
        for stop in range(start + 1, len(word) + 1):
            if word[start:stop] in pieces:
                score, used = after[stop]
                choices.append((score + pieces[word[start:stop]], used - 1))
        after[start] = max(choices)
    return -after[0][1]


def test_the_query_equals_an_independent_segmentation(spark):
    pieces = ranked_pieces()
    byte = min(pieces.values()) - 10_000
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    known = {w: fewest_of_best("▁" + w, pieces, byte) for w in {w for t in texts.values() for w in words(t)}}
    got = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in QUERIES["op1_token_counts"](spark, SF).collect()}
    assert got == {i: (len(words(t)), sum(known[w] for w in words(t))) for i, t in texts.items()}
    assert sum(n for _, n in got.values()) > len(texts)
