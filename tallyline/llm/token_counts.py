"""Token counts of texts of any length: huge texts in overlapping chunks that are spliced at common boundaries.

Texts up to ``chunk_chars`` bytes are cut at stable boundaries (see ``bpe``), where equal parts are encoded once. A
longer text is encoded chunk by chunk with offsets. Two neighbouring chunks share ``overlap`` characters; they
are spliced where both have a token that starts at the same stable boundary inside the shared stretch: the
tokens of the left chunk before it and those of the right chunk from it on are those of the whole text. Where
the chunks have no such place in common the overlap is doubled, at last up to the left chunk's own start, and
then the left chunk is made longer.

Null and empty texts have 0 tokens. Rows are kept as they come, repeated ones too; columns named as results are
replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from tallyline.llm.blocks import WHITE
from tallyline.llm.bpe import _WIDE, _WIDER, encoder
from tallyline.llm.tables import add_text_columns, fields, table

CHUNK = 1 << 15
OVERLAP = 1 << 9

_UNICODE_WHITE = {bytes(int(x).to_bytes(2, "big")).decode() for x in _WIDE} | {
    bytes(int(x).to_bytes(3, "big")).decode() for x in _WIDER
}


def _stable(text: str, p: int) -> bool:
    before = text[p - 1]
    return (
        ord(text[p]) < 128 and bool(WHITE[ord(text[p])])
        and before > " " and before != "\x7f" and before not in _UNICODE_WHITE
    )


def _starts(tokenizer, text: str, begin: int, end: int) -> np.ndarray:
    offsets = tokenizer.encode(text[begin:end], add_special_tokens=False).offsets
    return np.fromiter((o[0] for o in offsets), np.int64, len(offsets)) + begin


def count_spliced(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of ``text`` from overlapping chunks of ``chunk`` characters."""
    n, total, counted = len(text), 0, 0
    begin, end = 0, min(chunk, n)
    left = _starts(tokenizer, text, begin, end)
    while end < n:
        width, splice = min(overlap, end - begin), None
        while True:
            nearer = max(end - width, counted + 1)
            upto = min(nearer + max(chunk, 2 * width), n)
            right = _starts(tokenizer, text, nearer, upto)
            common = np.intersect1d(left[(left > nearer) & (left < end)], right)
            splice = next((int(p) for p in common[::-1] if _stable(text, int(p))), None)
            if splice is not None or nearer == counted + 1:
                break
            width *= 2
        if splice is None:  # no boundary at all since the last splice: a longer left chunk
            end = min(end + (end - begin), n)
            left = _starts(tokenizer, text, begin, end)
            continue
        total += int(((left >= counted) & (left < splice)).sum())
        counted, begin, end, left = splice, nearer, upto, right
    return total + int((left >= counted).sum())


def count_tokens(
    docs: DataFrame, vocabulary: str, text: str = "text", limit: int = 512, chunk_chars: int = CHUNK,
    overlap: int = OVERLAP, drop_text: bool = False,
) -> DataFrame:
    """Adds ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) to each row."""

    def maker():
        own = encoder(vocabulary)

        def compute(data, at):
            lengths = np.diff(at)
            huge = np.flatnonzero(lengths > chunk_chars)
            inner = np.ones(len(data), bool)
            short = lengths.copy()
            for i in huge:
                inner[at[i] : at[i + 1]] = False
                short[i] = 0
            counts = own.counts(data[inner] if len(huge) else data, np.r_[0, np.cumsum(short)])
            for i in huge:
                whole = data[at[i] : at[i + 1]].tobytes().decode()
                counts[i] = count_spliced(own.tokenizer, whole, chunk_chars, overlap)
            return [lengths, counts, counts > limit]

        return compute

    return add_text_columns(docs, text, fields(n_bytes="long", n_tokens="long", over_limit="boolean"), maker, drop_text)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), drop_text=True)
