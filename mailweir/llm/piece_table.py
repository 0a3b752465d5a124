"""SentencePiece BPE, encoded by a table of the last piece of every prefix, and decoded.

Merging the best pair again and again gives each prefix of a text one last piece, and a
sequence of pieces is an encoding if every two neighbours are one: merging both joined ends
at just these two. So a text is read once: an automaton names the pieces that end at
each place, the one that is compatible with the last piece of the prefix before it is stored
there, and the pieces are recovered from the end backwards. Time grows with the text.

Texts are cut into chunks that no piece crosses, where the model allows it, and each batch's
distinct chunks are worked on side by side, place by place. Whether two pieces are
compatible is found by merging them once and is then looked up.

The model has to be BPE with byte fallback, a space put before the text and no other
normalisation; one that encodes probe texts otherwise is refused. NULL and empty texts have no
ids and decode to an empty text. NULL and repeated doc_ids are kept, row by row; other
columns are dropped; an empty table stays empty. A text of any length is encoded whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweir.llm.chunks import bounded, cut, ragged
from mailweir.llm.common import table, text_or_empty
from mailweir.session import spread

SPACE = "▁"
#: Characters that are matched at a time, and verdicts on pairs that are remembered.
BLOCK_CHARS = 1 << 18
PAIR_SLOTS = 1 << 21
PAIR_CACHE = 1 << 20
#: Characters of a chunk from which it is worked on alone.
LONG_CHUNK = 256

_PROBES = (
    "", " ", "a", "  two  spaces  ", "tab\there\nline\r\n\n", "café café ﬁ Ａ ▁x ▁",
    "世界\u0001\x00 ﻿\U0001f600\U000e0001", "<s></s><unk><0x41>", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    " " * 40 + "x" + " " * 17, "12345 3.14 $$$***((()))", "The quick brown fox, jumping overlazily.",
)


def _hashed(keys: np.ndarray, slots: int) -> np.ndarray:
    """A place among a power of two of them."""
    return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) & (slots - 1)


class PieceTable:
    """The pieces of one model, their automaton and the verdicts on pairs found so far."""

    def __init__(self, model: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=model)
        n = library.get_piece_size()
        names = [library.id_to_piece(i) for i in range(n)]
        special = [library.is_control(i) or library.is_unknown(i) or library.is_unused(i) for i in range(n)]
        byte = [library.is_byte(i) for i in range(n)]
        if sum(byte) != 256:
            raise ValueError(f"{model} has no pieces for all bytes")
        self.byte_ids = np.zeros(256, np.int64)
        self.values = [b""] * n
        for i, name in enumerate(names):
            if byte[i]:
                self.byte_ids[int(name[3:5], 16)] = i
                self.values[i] = bytes([int(name[3:5], 16)])
            elif library.is_unknown(i):
                # What the library writes for its unknown piece.
                self.values[i] = library.decode([i]).encode()
            elif not special[i]:
                self.values[i] = name.replace(SPACE, " ").encode()
        self.is_byte = np.array(byte)
        self.spelled = pa.array(self.values, pa.binary())
        normal = [i for i in range(n) if not special[i] and not byte[i]]
        self.score = {names[i]: library.get_score(i) for i in normal}
        # Symbols: the pieces, then characters that only longer pieces have, then one for all others.
        extra = sorted({c for i in normal for c in names[i]} - {names[i] for i in normal})
        self.symbols = names + extra
        self.size = len(self.symbols) + 1
        self.stranger = self.size - 1
        self.n_pieces = n
        self.lengths = np.array([len(s) for s in self.symbols] + [1], np.int32)
        alphabet = sorted({c for i in normal for c in names[i]})
        self._automaton([*normal, *range(n, len(self.symbols))], alphabet)
        self.mark = next(c for c in map(chr, range(0xE000, 0xF8FF)) if c not in alphabet)
        # A chunk may begin at a space or line feed if no piece has one behind another character.
        self.whole = "\n" in alphabet or any(SPACE in names[i].lstrip(SPACE) for i in normal)
        self.slots = np.full(PAIR_SLOTS, -1, np.int64)
        self.answers = np.zeros(PAIR_SLOTS, bool)
        self.verdicts: dict[int, bool] = {}
        for text in _PROBES:
            if self.encode([text])[0].tolist() != library.encode(text):
                raise ValueError(f"{model} encodes {text!r} in a way that is not supported")

    def _automaton(self, symbols: list[int], alphabet: list[str]) -> None:
        """States by first characters; an edge is filed in a hash table by state and letter."""
        self.letter = np.zeros(ord(alphabet[-1]) + 2, np.int64)
        self.letter[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        self.n_letters = len(alphabet) + 1
        edges: dict[int, int] = {}
        named = {}
        for i in symbols:
            state = 0
            for c in self.symbols[i]:
                state = edges.setdefault(state * self.n_letters + int(self.letter[ord(c)]), len(edges) + 1)
            named[state] = i
        self.names = np.full(len(edges) + 1, -1, np.int32)
        self.names[list(named)] = list(named.values())
        slots = 1 << (8 * len(edges)).bit_length()
        self.edge_keys = np.full(slots, -1, np.int64)
        self.edge_ends = np.zeros(slots, np.int32)
        keys = np.fromiter(edges, np.int64, len(edges))
        for key, end, slot in zip(keys.tolist(), edges.values(), _hashed(keys, slots).tolist()):
            while self.edge_keys[slot] >= 0:
                slot = (slot + 1) % slots
            self.edge_keys[slot] = key
            self.edge_ends[slot] = end

    def merged(self, text: str) -> list[str]:
        """Merge the best pair, the leftmost of equals, until none is left."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            found = [score.get(a + b) for a, b in zip(parts, parts[1:])]
            best = max((s for s in found if s is not None), default=None)
            if best is None:
                break
            at = found.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compatible(self, key: int) -> bool:
        left, right = divmod(key, self.size)
        left -= 1
        if self.stranger in (left, right):
            # A character that is in no piece meets nothing; what is beside it must stand alone.
            other = [self.symbols[x] for x in (left, right) if x not in (-1, self.stranger)]
            return all(self.merged(x) == [x] for x in other)
        pair = [self.symbols[x] for x in (left, right) if x != -1]
        return self.merged("".join(pair)) == pair

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each right symbol may follow the left one; -1 at the left is the beginning."""
        keys = (left + np.int64(1)) * self.size + right
        slot = _hashed(keys, PAIR_SLOTS)
        ok = self.answers[slot]
        missed = np.flatnonzero(self.slots[slot] != keys)
        if len(missed):
            new, back = np.unique(keys[missed], return_inverse=True)
            if len(self.verdicts) > PAIR_CACHE:
                self.verdicts.clear()
            answers = np.zeros(len(new), bool)
            for k, key in enumerate(new.tolist()):
                answer = self.verdicts.get(key)
                if answer is None:
                    answer = self.verdicts[key] = self._compatible(key)
                answers[k] = answer
            ok[missed] = answers[back]
            self.slots[slot[missed]] = keys[missed]
            # Of several keys in a slot the one that stands there last has to be the one answered.
            held, order = np.unique(slot[missed], return_index=True)
            where = np.searchsorted(new, self.slots[held])
            self.answers[held] = answers[where]
        return ok

    def _matches(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where every piece found in the characters begins, and which it is.

        The automaton is walked from all places at once, one character at a time.
        """
        letters = np.append(self.letter[np.minimum(chars, len(self.letter) - 1)], 0)
        at = np.flatnonzero(letters).astype(np.int32)
        state, ahead = np.zeros(len(at), np.int64), at
        begins, found = [], []
        while len(at):
            state = self._goto(state * self.n_letters + letters[ahead])
            alive = np.flatnonzero(state)
            at, ahead, state = at[alive], ahead[alive] + 1, state[alive]
            named = self.names[state]
            hit = np.flatnonzero(named >= 0)
            begins.append(at[hit])
            found.append(named[hit])
        if not begins:
            return np.zeros(0, np.int32), np.zeros(0, np.int32)
        return np.concatenate(begins), np.concatenate(found)

    def _goto(self, keys: np.ndarray) -> np.ndarray:
        """The automaton's next states; 0 where it ends."""
        slots = len(self.edge_keys)
        slot = _hashed(keys, slots)
        held = self.edge_keys[slot]
        out = np.where(held == keys, self.edge_ends[slot], 0)
        again = np.flatnonzero((held != keys) & (held >= 0))
        slot = slot[again]
        while len(again):
            slot = (slot + 1) % slots
            held = self.edge_keys[slot]
            right = held == keys[again]
            out[again[right]] = self.edge_ends[slot[right]]
            more = ~right & (held >= 0)
            again, slot = again[more], slot[more]
        return out

    def _block(self, chars: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks one after the other, and how many each has.

        ``chars`` are the code points of all chunks, with a mark between any two.
        """
        size = len(chars)
        starts = np.cumsum(lengths + 1) - lengths - 1
        begins, symbols = self._matches(chars)
        strange = self.letter[np.minimum(chars, len(self.letter) - 1)] == 0
        strange[starts[1:] - 1] = False
        strange = np.flatnonzero(strange).astype(np.int32)
        begins = np.concatenate([begins, strange])
        symbols = np.concatenate([symbols, np.full(len(strange), self.stranger, np.int32)])
        ends = begins + self.lengths[symbols]
        owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths + 1)
        owner = owner[begins]
        last = np.full(size + 1, -2, np.int32)
        last[starts] = -1
        long = lengths > LONG_CHUNK
        if long.any():
            mine = long[owner]
            self._one_by_one(last, begins[mine], symbols[mine], ends[mine])
            begins, symbols, ends, owner = (x[~mine] for x in (begins, symbols, ends, owner))
        within = (ends - starts[owner]).astype(np.uint16)
        order = np.argsort(within, kind="stable")
        ends, symbols, begins = ends[order], symbols[order], begins[order]
        edges = np.searchsorted(within[order], np.arange(1, int(within.max(initial=0)) + 2))
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            before = last[begins[lo:hi]]
            ok = self.compatible(before, symbols[lo:hi]) & (before != -2)
            last[ends[lo:hi][ok]] = symbols[lo:hi][ok]
        return self._recovered(last, starts, lengths, chars)

    def _one_by_one(self, last, begins, symbols, ends) -> None:
        """The same for long chunks, which are too few to be worked on side by side."""
        order = np.lexsort((symbols, ends))
        verdicts = self.verdicts
        for begin, symbol, end in zip(begins[order].tolist(), symbols[order].tolist(), ends[order].tolist()):
            before = int(last[begin])
            if before != -2 and last[end] < 0:
                key = (before + 1) * self.size + symbol
                answer = verdicts.get(key)
                if answer is None:
                    answer = verdicts[key] = self._compatible(key)
                if answer:
                    last[end] = symbol

    def _recovered(self, last, starts, lengths, chars) -> tuple[np.ndarray, np.ndarray]:
        """The pieces from the end of every chunk backwards."""
        who = np.flatnonzero((lengths > 0) & (lengths <= LONG_CHUNK))
        at, steps = (starts + lengths)[who], []
        counts = np.zeros(len(lengths), np.int64)
        while len(who):
            symbol = last[at]
            steps.append((who, symbol))
            counts[who] += 1
            at = at - self.lengths[symbol]
            more = at > starts[who]
            who, at = who[more], at[more]
        paths = {}
        for chunk in np.flatnonzero(lengths > LONG_CHUNK).tolist():
            at, start, path = int(starts[chunk] + lengths[chunk]), int(starts[chunk]), []
            while at > start:
                path.append(int(last[at]))
                at -= int(self.lengths[path[-1]])
            paths[chunk] = path[::-1]
            counts[chunk] = len(path)
        upto = np.cumsum(counts)
        out = np.zeros(int(upto[-1]) if len(upto) else 0, np.int32)
        for back, (who, symbol) in enumerate(steps):
            out[upto[who] - 1 - back] = symbol
        for chunk, path in paths.items():
            out[upto[chunk] - len(path) : upto[chunk]] = path
        strange = np.flatnonzero(out >= self.n_pieces)
        if len(strange):
            # Characters that are no piece become the pieces of their bytes.
            owner = np.searchsorted(upto, strange, "right")
            width = self.lengths[out]
            place = np.cumsum(width) - width - (np.cumsum(lengths) - lengths)[np.searchsorted(upto, np.arange(len(out)), "right")]
            points = chars[starts[owner] + place[strange]]
            kinds, back = np.unique(points, return_inverse=True)
            pieces = [self.byte_ids[list(chr(c).encode())] for c in kinds.tolist()]
            sizes = np.ones(len(out), np.int64)
            sizes[strange] = np.array([len(p) for p in pieces])[back]
            np.add.at(counts, owner, sizes[strange] - 1)
            repeated = np.repeat(out >= self.n_pieces, sizes)
            out = np.repeat(out, sizes)
            out[repeated] = np.concatenate([pieces[k] for k in back.tolist()])
        return out, counts

    def encode_chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks, a leading space included, one after the other; and their numbers."""
        lengths = pc.utf8_length(chunks).to_numpy(zero_copy_only=False).astype(np.int64)
        upto = np.cumsum(lengths + 1)
        found, at = [], 0
        while at < len(chunks):
            before = upto[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(upto, before + BLOCK_CHARS, "right")))
            joined = self.mark.join(chunks.slice(at, to - at).to_pylist()).replace(" ", SPACE)
            chars = np.frombuffer(joined.encode("utf-32-le"), "<u4")
            found.append(self._block(chars, lengths[at:to]))
            at = to
        if not found:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after the other, and where each text's ids start."""
        numbers, offsets, chunks = cut(texts, self.whole)
        ids, counts = self.encode_chunks(chunks)
        starts = np.cumsum(counts) - counts
        lengths = counts[numbers]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        return ids[ragged(starts[numbers], lengths)], upto[offsets]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        ids, offsets = self.encode_array(pa.array(texts, pa.string()))
        return [ids[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes of pieces joined, the space in front taken off."""
        parts: list[str] = []
        at = 0
        while at < len(ids):
            if not self.is_byte[ids[at]]:
                parts.append(self.values[ids[at]].decode())
                at += 1
                continue
            upto = at
            while upto < len(ids) and self.is_byte[ids[upto]]:
                upto += 1
            parts.append(_repaired(b"".join(self.values[i] for i in ids[at:upto])))
            at = upto
        if ids and not self.is_byte[ids[0]] and parts[0].startswith(" "):
            parts[0] = parts[0][1:]
        return "".join(parts)


def _repaired(data: bytes) -> str:
    """UTF-8, with a replacement character for every single byte that is not part of it."""
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode())
            break
        except UnicodeDecodeError as error:
            out.append(data[at : at + error.start].decode())
            out.append("�")
            at += error.start + 1
    return "".join(out)


@lru_cache(maxsize=2)
def piece_table(model: str) -> PieceTable:
    """The table of a model, made once per Python worker."""
    return PieceTable(model)


def _ids(pieces: PieceTable, texts: pa.Array) -> pa.ListArray:
    ids, offsets = pieces.encode_array(texts)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))


def _texts(pieces: PieceTable, lists: pa.ListArray) -> pa.Array:
    """The text of each list of ids."""
    lists = pc.fill_null(lists, pa.scalar([], pa.list_(pa.int32())))
    flat = lists.flatten()
    n = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    upto = np.concatenate([[0], np.cumsum(n)])
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pieces.spelled.take(flat)), b"")
    first = flat.take(pa.array(np.minimum(upto[:-1], max(len(flat) - 1, 0)))).to_numpy() if len(flat) else n
    spaced = (n > 0) & ~pieces.is_byte[first]
    out = []
    for row, data in enumerate(joined.to_pylist()):
        try:
            text = data.decode()
            out.append(text[1:] if spaced[row] and data[:1] == b" " else text)
        except UnicodeDecodeError:
            out.append(pieces.decode(lists[row].as_py()))
    return pa.array(out, pa.string())


def _rows(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, str]:
    rows = spread(docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text")))
    return rows, rows.schema["doc_id"].dataType.simpleString()


def encode(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids``: the ids of every whole text, in the order of the text."""
    rows, kind = _rows(docs, doc_id, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_table(model)
        for part in (p for batch in batches for p in bounded(batch)):
            lists = _ids(pieces, part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """The rows with a column ``decoded``; NULL ids decode to an empty text."""
    fields = [f for f in encoded.schema.fields if f.name != "decoded"]
    names = [f.name for f in fields]
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_table(model)
        for batch in batches:
            columns = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays([*columns, _texts(pieces, batch.column(ids))], [*names, "decoded"])

    return encoded.select(*names).mapInArrow(run, f"{head}, decoded string")


def coded(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids, decoded``: ``decode(encode(..))`` with one Python worker a task instead of two."""
    rows, kind = _rows(docs, doc_id, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_table(model)
        for part in (p for batch in batches for p in bounded(batch)):
            lists = _ids(pieces, part.column("text"))
            columns = [part.column("doc_id"), lists, _texts(pieces, lists)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])
            del lists, columns
            pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def op12_piece_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text they decode to, as digests."""
    import public_tokenizers

    done = coded(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return done.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
    )


QUERIES = {"op12_piece_table": op12_piece_table}
ORACLE: dict[str, str] = {}
