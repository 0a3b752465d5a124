"""Long texts, long chains and other tokenizers."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from mailweir.llm import license_templates, link_trust, simple8b


def test_time_for_licenses_grows_with_the_text():
    templates = license_templates._compiled(license_templates.TEMPLATES)
    words = license_templates.plain_words("licensed under the " * 70_000)
    started = time.perf_counter()
    found = license_templates.scan_words(words, license_templates.PHRASES, templates)
    assert found["n_words"] == 210_000 and found["labels"] == "" and time.perf_counter() - started < 10
    anchors = " ".join(t.anchor.decode() for t in templates)
    words = license_templates.plain_words((anchors + " ") * 300)
    started = time.perf_counter()
    license_templates.scan_words(words, license_templates.PHRASES, templates)
    assert time.perf_counter() - started < 10


def test_one_pass_finds_what_single_starts_find():
    draw = random.Random(8)
    t = license_templates.Template("t", 'a b <<beginOptional>>c<<endOptional>> <<var;match="[a-c]";words="1..3">> d 2')
    for _ in range(3000):
        words = [draw.choice([b"a", b"b", b"c", b"d", b"2"]) for _ in range(draw.randrange(14))]
        starts = [k for k in range(len(words)) if words[k : k + 2] == [b"a", b"b"]]
        assert t.found(words, starts) == any(t.accepts(words[k:]) for k in starts)


def test_a_chain_of_thirty_hosts_is_reached(spark):
    rows = [(k, f"http://h{k}.net/", f'<a href="http://h{k + 1}.net/">') for k in range(30)]
    rows.append((30, "http://h30.net/bad", ""))
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r["page_id"]: r for r in link_trust.judge(pages, rules=[("block", "h30.net/bad")]).collect()}
    assert all(got[k]["verdict"] == "block" and got[k]["distrust"] > 0 for k in range(31))
    assert got[0]["distrust"] == pytest.approx(0.15 * 0.85**30, rel=1e-3)


def test_settled_scores_are_those_of_many_rounds(spark):
    draw = random.Random(4)
    edges = {(f"h{draw.randrange(12)}", f"h{draw.randrange(12)}") for _ in range(30)}
    edges = [(a, b, float(1 + draw.randrange(3))) for a, b in sorted(edges) if a != b]
    seeds = [("h1", "trust", 2.0), ("h2", "trust", 1.0), ("h3", "distrust", 1.0)]
    got = {r["host"]: r for r in link_trust.propagate(
        spark.createDataFrame(edges, "src string, dst string, weight double"),
        spark.createDataFrame(seeds, "host string, kind string, weight double"),
    ).collect()}
    hosts = [f"h{k}" for k in range(12)]
    for kind, turned in (("trust", False), ("distrust", True)):
        flow = np.zeros((12, 12))
        for a, b, w in edges:
            a, b = (b, a) if turned else (a, b)
            flow[hosts.index(b), hosts.index(a)] += w
        flow /= np.maximum(flow.sum(axis=0), 1e-300)
        restart = np.array([sum(w for h, k, w in seeds if (h, k) == (x, kind)) for x in hosts])
        want = np.linalg.solve(np.eye(12) - 0.85 * flow, 0.15 * restart / restart.sum())
        assert [got[h][kind] if h in got else 0.0 for h in hosts] == pytest.approx(want, abs=2e-6)


def test_another_tokenizer_gives_its_own_ids():
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    texts = ["Hello  World\n\tit's 3.14", "", "Éa b", "word " * 50]
    for name, by_words in (("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)):
        encoder = simple8b._Encoder(P.path(name))
        assert encoder.by_words == by_words
        ids, sizes = encoder.encode(pa.array(texts))
        want = [e.ids for e in Tokenizer.from_file(P.path(name)).encode_batch(texts, add_special_tokens=False)]
        assert sizes.tolist() == list(map(len, want)) and ids.tolist() == [i for x in want for i in x]
