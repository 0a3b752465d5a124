"""Texts cut where no tokenizer's token can cross, so that a chunk is tokenised once for many texts.

A text, with a space put before it, is cut before every single space, and before and behind
every single line feed, that stands between characters no tokenizer takes for white space.
White space of any other kind or number stays inside its chunk. The chunks joined are the text.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task cuts and encodes at a time; a longer text is taken alone.
PIECE_BYTES = 4 << 20

# Characters that some tokenizer may take for white space; U+2581 stands for a space in pieces.
_BLANKS = (
    ("00", "20"), ("7f", "a0"), ("1680", "1680"), ("180e", "180e"), ("2000", "200f"),
    ("2028", "202f"), ("205f", "2060"), ("2581", "2581"), ("3000", "3000"), ("feff", "feff"),
)
_X = "".join(re.escape(chr(int(a, 16))) + "-" + re.escape(chr(int(b, 16))) for a, b in _BLANKS)
# Rest of a chunk: white space that is no single space or line feed, and what follows it.
_REST = rf"(?:(?![ \n][^{_X}])[{_X}]+[^{_X}]*)*"
_CHUNK = re.compile(rf"(?<=[^{_X}])\n(?=[^{_X}])| ?[^{_X}]+{_REST}|[{_X}]+[^{_X}]*{_REST}")
# The same in the syntax of Arrow's patterns: texts with any such white space.
_ODD = (
    r"\A[ \n]|[ \n]\z|[ \n][ \n]|[\x00-\x09\x0b-\x1f\x7f-\x{a0}"
    + "".join(rf"\x{{{a}}}-\x{{{b}}}" for a, b in _BLANKS[2:]) + "]"
)
_CUT = "\x01"


def chunks_of(text: str) -> list[str]:
    """The chunks of one text; of an empty text none."""
    return _CHUNK.findall(" " + text) if text else []


def _lists(texts: pa.Array) -> pa.Array:
    inner = pc.replace_substring(texts, " ", _CUT + " ")
    inner = pc.replace_substring(inner, "\n", f"{_CUT}\n{_CUT}")
    return pc.split_pattern(pc.binary_join_element_wise(pa.scalar(" ", texts.type), inner, ""), _CUT)


def cut(texts: pa.Array, whole: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Number of each chunk, where each text's numbers start, and the distinct chunks.

    NULL and empty texts have no chunks. ``whole`` leaves each text one chunk.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.string())
    if whole:
        lists = pa.array([[" " + t] if t else [] for t in texts.to_pylist()], pa.list_(pa.string()))
    else:
        odd = np.asarray(pc.or_(pc.match_substring_regex(texts, _ODD), pc.equal(texts, "")))
        if odd.any():
            plain, rest = np.flatnonzero(~odd), np.flatnonzero(odd)
            found = pa.array([chunks_of(t) for t in texts.take(rest).to_pylist()], pa.list_(pa.string()))
            lists = pa.concat_arrays([_lists(texts.take(plain)), found])
            lists = lists.take(np.argsort(np.concatenate([plain, rest])))
        else:
            lists = _lists(texts)
    coded = lists.flatten().dictionary_encode()
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return coded.indices.to_numpy().astype(np.int64), offsets, coded.dictionary


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``starts[k] .. starts[k] + lengths[k] - 1`` of all stretches, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()), dtype=np.int64)


def bounded(batch: pa.RecordBatch, text: str = "text", most: int = PIECE_BYTES):
    """The batch in stretches of ``most`` bytes of text, a text at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, upto - at)
        at = upto
