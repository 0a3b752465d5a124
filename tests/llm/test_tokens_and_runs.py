"""Periodic runs, SentencePiece coding and token alignment against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from mailweir.llm import chunks, periodic_runs, piece_table, token_align

P = pytest.importorskip("public_tokenizers")
PIECES, BYTES = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.json")
SMALL = "/root/testdata/sf0.001/documents.parquet"

ODD = [
    (1, None), (2, ""), (3, " "), (4, "  \n\t "), (5, "x"), (6, "one two"), (7, "one two"), (7, "one two"),
    (None, "a b a b a b a b a b a b a b"), (None, None), (8, "▁marked▁ text"), (9, "<s> </s> <|endoftext|> <0x41>"),
    (10, "a\nb\n\nc \n d e f\u0085g \x00 \x1c h"), (11, "世界 \U0001f600 émigré́ ١٢٣ ǅ"), (12, "it's we'll 'tis don't\n's x's"),
    (13, "z" * 3000), (14, "no" + " " * 50 + "yes\n" * 20), (15, "end \n"), (16, "\nstart"), (17, "a▁ b"), (18, "tab\tword\r\nnext"),
]


def query_rows(spark, tmp_path, query, rows):
    path = tmp_path / "documents.parquet"
    wide = [(i, t, "n_a", 5, "x") for i, t in rows]
    spark.createDataFrame(wide, "doc_id bigint, text string, `key` string, `copies` int, `ids` string").write.parquet(str(path))
    return query(spark, str(tmp_path)).collect()


def drawn(seed, n, vocabulary):
    draw = random.Random(seed)
    return [f"w{draw.randrange(vocabulary)}" for _ in range(n)]


# ---- chunks ----------------------------------------------------------------------------

def test_chunks_join_to_the_text_and_are_cut_at_single_blanks():
    for _, text in ODD:
        assert "".join(chunks.chunks_of(text or "")) == (" " + text if text else "")
    assert chunks.chunks_of("ab c\nd  e") == [" ab", " c", "\n", "d  e"]
    import pyarrow as pa

    texts = [t for _, t in ODD]
    numbers, offsets, distinct = chunks.cut(pa.array(texts))
    for text, a, b in zip(texts, offsets, offsets[1:]):
        assert [distinct[int(k)].as_py() for k in numbers[a:b]] == chunks.chunks_of(text or "")


# ---- periodic runs ---------------------------------------------------------------------

def plain_runs(words, least):
    """By definition: every period, every stretch in which it holds, that has no smaller one."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            run = words[i : j + q]
            if len(run) >= max(least, 2 * q) and not any(
                all(run[k] == run[k + d] for k in range(len(run) - d)) for d in range(1, q)
            ):
                out.append((i, len(run), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_words_equal_their_definition():
    draw = random.Random(3)
    for k in range(1500):
        n, kinds = draw.randrange(60), draw.choice([1, 2, 3, 6])
        words = [b"%d" % draw.randrange(kinds) for _ in range(n)]
        if k % 2 and n > 20:
            a, p = draw.randrange(n // 2), 1 + draw.randrange(8)
            words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
        for least in (2, 5, 12):
            assert periodic_runs.text_runs(words, least) == plain_runs(words, least)


def test_extensions_are_those_of_the_suffixes():
    import numpy as np

    draw = random.Random(4)
    values = [draw.randrange(3) for _ in range(80)]
    tree = periodic_runs.SuffixTree(values)
    pairs = [(i, j) for i in range(81) for j in range(81) if i != j]
    got = tree.common(np.array([i for i, _ in pairs]), np.array([j for _, j in pairs]))
    for (i, j), length in zip(pairs, got.tolist()):
        want = 0
        while max(i, j) + want < 80 and values[i + want] == values[j + want]:
            want += 1
        assert length == want
    assert [tuple(values[k:]) for k in tree.order.tolist()] == sorted(tuple(values[k:]) for k in range(81))
    turned = [3 - v for v in values]
    assert tree.opposite().tolist() == sorted(range(81), key=lambda k: turned[k:])


def test_op11_equals_a_plain_version(spark, tmp_path):
    rows = list(ODD)
    for k in range(60):
        words = drawn(k, 20 + 5 * k, 3 if k % 3 == 0 else 200)
        if k % 4 == 0:
            words = words[:10] + words[10:17] * 6 + words
        rows.append((100 + k, (" ", "\n", "\t ")[k % 3].join(words)))
    rows += [(500, " ".join(["same"] * 700)), (501, " ".join(drawn(9, 6000, 5000)))]
    found = query_rows(spark, tmp_path, periodic_runs.op11_periodic_runs, rows)
    want = []
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
        runs = plain_runs(words, 12) if n < 5000 else periodic_runs.text_runs([w.encode() for w in words])
        drop = {i for s, m, q in runs for i in range(s + q, s + m)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        kept = " ".join(w for i, w in enumerate(words) if i not in drop)
        want.append((
            doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
        ))
    assert Counter(map(tuple, found)) == Counter(want)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows)


def test_a_long_text_of_few_words_is_worked_on_whole():
    words = [b"a", b"b"] * 40_000 + [b"c"] + [b"d"] * 20_000
    assert periodic_runs.text_runs(words) == [(0, 80_000, 2), (80_001, 20_000, 1)]


# ---- SentencePiece ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def soup(seed):
    draw = random.Random(seed)
    parts = ["a", "th", "the", " ", "  ", "\n", "é", "▁", "<s>", "\U0001f600", "世", "\x00", "ing", "19", ".", "'s", "ll", "zz", "$$", "﻿"]
    return "".join(draw.choice(parts) for _ in range(draw.randrange(60)))


def test_ids_and_texts_are_the_librarys(library):
    pieces = piece_table.piece_table(PIECES)
    texts = [t or "" for _, t in ODD] + [soup(k) for k in range(800)]
    got = pieces.encode(texts)
    for text, ids in zip(texts, got):
        assert ids.tolist() == library.encode(text), text
        assert pieces.decode(ids.tolist()) == library.decode(ids.tolist())
    draw = random.Random(1)
    for _ in range(500):
        ids = [draw.randrange(3, 32000) if draw.random() < 0.5 else draw.randrange(3, 259) for _ in range(9)]
        assert pieces.decode(ids) == library.decode(ids)


def test_long_chunks_and_small_blocks_change_nothing(library, monkeypatch):
    draw = random.Random(2)
    texts = ["".join(draw.choice("abcdehinrst é") for _ in range(3000)), "q" * 2000, "".join(draw.choice("etaoin") for _ in range(5000))]
    pieces = piece_table.PieceTable(PIECES)
    for blocks, long in ((1 << 20, 256), (64, 8), (1 << 20, 1 << 14)):
        monkeypatch.setattr(piece_table, "BLOCK_CHARS", blocks)
        monkeypatch.setattr(piece_table, "LONG_CHUNK", long)
        assert [x.tolist() for x in pieces.encode(texts)] == [library.encode(t) for t in texts]


def test_the_last_piece_of_a_prefix_is_unique(library):
    """Exactly one piece that ends at a place is compatible with the one before it."""
    pieces = piece_table.PieceTable(PIECES)
    text = "▁overlazily▁jumping"
    last = {0: -1}
    for end in range(1, len(text) + 1):
        fit = [
            s for begin in range(end) if (s := {n: i for i, n in enumerate(pieces.symbols)}.get(text[begin:end])) is not None
            and pieces._compatible((last[begin] + 1) * pieces.size + s)
        ]
        assert len(fit) == 1
        last[end] = fit[0]


def test_op12_equals_the_library(spark, tmp_path, library):
    rows = ODD + [tuple(r) for r in spark.read.parquet(SMALL).select("doc_id", "text").collect()]
    found = query_rows(spark, tmp_path, piece_table.op12_piece_table, rows)
    want = Counter()
    for doc_id, text in rows:
        ids = library.encode(text or "")
        decoded = library.decode(ids) if ids else ""
        want[(
            doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )] += 1
    assert Counter(map(tuple, found)) == want


def test_encoding_and_decoding_alone(spark, library):
    df = spark.createDataFrame([(i, t, "x") for i, t in ODD], "doc_id bigint, text string, decoded string")
    ids = piece_table.encode(df, PIECES)
    back = piece_table.decode(ids.withColumn("decoded", ids["doc_id"]), PIECES).collect()
    want = [(i, library.encode(t or ""), library.decode(library.encode(t or "")) or "") for i, t in ODD]
    key = lambda r: (str(r[0]), r[1])
    assert sorted(map(tuple, back), key=key) == sorted(want, key=key)
    nothing = spark.createDataFrame([(1, None), (2, [])], "n int, ids array<int>")
    assert [r["decoded"] for r in piece_table.decode(nothing, PIECES).collect()] == ["", ""]


# ---- alignment -------------------------------------------------------------------------

def plain_alignment(rows, library):
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    letters = token_align._letters()
    docs, pairs = [], Counter()
    for doc_id, text in rows:
        groups, links = [], Counter()
        n_a = n_b = 0
        if text:
            data = b" " + text.encode()
            sides = []
            for ids, value in (
                (a.encode(" " + text, add_special_tokens=False).ids, lambda i: bytes(letters[c] for c in a.id_to_token(i))),
                (library.encode(text), lambda i: bytes([int(library.id_to_piece(i)[3:5], 16)]) if library.is_byte(i)
                 else library.id_to_piece(i).replace("▁", " ").encode()),
            ):
                at, ends = 0, []
                for i in ids:
                    at += len(value(i))
                    ends.append((i, at))
                sides.append(ends)
                if b"".join(map(value, ids)) != data:
                    sides = [[], []]
                    break
            n_a, n_b = map(len, sides)
            cuts = sorted({e for _, e in sides[0]} & {e for _, e in sides[1]})
            before = 0
            for c in cuts:
                left, right = ([i for i, e in side if before < e <= c] for side in sides)
                groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
                links.update((x, y) for x in left for y in right)
                before = c
        docs.append((doc_id, n_a, n_b, groups, links))
        pairs.update(links.keys())
    most = Counter()
    for (x, _), n in pairs.items():
        most[x] = max(most[x], n)
    out = Counter()
    for doc_id, n_a, n_b, groups, links in docs:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out[(
            doc_id, n_a, n_b, len(groups), sum(links.values()),
            sum(n for p, n in links.items() if pairs[p] == most[p[0]]), sum(n * pairs[p] for p, n in links.items()), digest,
        )] += 1
    return out


def test_op13_equals_a_plain_version(spark, tmp_path, library):
    rows = ODD + [(1000 + k, soup(k)) for k in range(60)]
    rows += [(r["doc_id"], r["text"][:1500]) for r in spark.read.parquet(SMALL).collect()]
    found = query_rows(spark, tmp_path, token_align.op13_token_align, rows)
    assert Counter(map(tuple, found)) == plain_alignment(rows, library)


@pytest.mark.parametrize("hot", [1, 40])
def test_pairs_beyond_the_hot_ones_are_joined(spark, library, hot):
    rows = [(k, f"text number {k % 7} of the copies and {soup(k)}") for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = token_align.align(df, BYTES, PIECES, hot_pairs=hot).collect()
    want = {w[0]: w for w in plain_alignment(rows, library)}
    for r in got:
        assert (r["n_best"], r["count_sum"]) == want[r["doc_id"]][5:7]
        assert (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "") == want[r["doc_id"]][7]


def test_both_byte_level_ways_agree():
    aligner = token_align._aligner(BYTES, PIECES)
    import pyarrow as pa

    draw = random.Random(6)
    texts = [" " + "".join(draw.choice("abcdeEéñß'’s.,$#0123ll-_ðÿ") for _ in range(draw.randrange(1, 20))) for _ in range(20_000)]
    ids, n = aligner.byte_tokens(pa.array(texts))
    assert aligner.fast is not None
    want = [e.ids for e in aligner.a.encode_batch_fast(texts, add_special_tokens=False)]
    assert n.tolist() == list(map(len, want)) and ids.tolist() == [i for x in want for i in x]


def test_empty_tables_give_empty_results(spark, tmp_path):
    for k, query in enumerate((periodic_runs.op11_periodic_runs, piece_table.op12_piece_table, token_align.op13_token_align)):
        (tmp_path / str(k)).mkdir()
        assert query_rows(spark, tmp_path / str(k), query, []) == []
