"""Every operator on odd rows, against plain Python."""

import hashlib
import html
import math
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sightlake.llm import (
    decontaminate, frames, html_content, licenses, line_templates, quality_model, quality_rules,
    sentencepiece_codec, simhash, suffix_dedup, token_files,
)
from sightlake.llm.components import components
from sightlake.session import staging_path

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"word{i % 977} of{i % 31}" for i in range(20_000))
TEXTS = [
    "", None, " \n\t", "One.", "a\tb\n\na b", "Gnu General-Public\nLicense, MIT license. CC BY-SA 4.0",
    "éà 漢字 \U00010348 ▁▁ <s> <|endoftext|> İ \x00", LONG, LONG + " end", LONG, "b a a a a a a a a a a a",
    "Licensed under the Apache License, Version 2.0.\nAll rights reserved.",
]
SCHEMA = "doc_id long, text string, n_words string, Place int, ids string, results string"


def table(spark, texts=TEXTS):
    """Documents with a null id, a repeated row and columns whose names clash."""
    rows = [(i, t, "own", 7, "x", "r") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (None, "x y z", "own", 7, "x", "r"), rows[0]], SCHEMA)


def pairs(df, *columns):
    return [(r["doc_id"], *(r[c] for c in columns)) for r in df.collect()]


def test_sentencepiece_round_trip(spark):
    docs = table(spark)
    coded = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, PIECES), PIECES)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert coded.count() == docs.count() and "n_words" in coded.columns
    texts = [r["text"] for r in docs.collect()]
    for text, row in zip(texts, coded.collect(), strict=True):
        ids = [*model.encode(text or ""), model.eos_id()]
        assert row["ids"] == ids and row["decoded"] == model.decode(ids)
    assert sentencepiece_codec.encode(docs.limit(0), PIECES).count() == 0


def test_round_trip_encodes_once_and_in_parts(spark):
    long = "The clerk, page ４ é " * 150_000  # more than is coded at a time
    docs = table(spark, [*TEXTS, long, None, long]).withColumn("Decoded", F.lit("own"))
    found = sentencepiece_codec.round_trip(docs, PIECES, cached=20)
    assert sorted(found.columns) == sorted([*docs.columns[:-1], "decoded"])
    model = sentencepiece_codec.processor(PIECES)
    for row in found.collect():
        ids = [*model.encode(row["text"] or ""), model.eos_id()]
        assert row["ids"] == ids and row["decoded"] == model.decode(ids)
    assert sentencepiece_codec.round_trip(docs.limit(0), PIECES).count() == 0
    # Of two functions, one on the other's result, Spark ran the first for itself and again for the second.
    plan = corpus_pipeline.tokens(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert "pythonUDF0" in plan and "pythonUDF1" not in plan


def test_prefix_encoder_on_random_texts():
    coder, draw = sentencepiece_codec.PrefixEncoder(PIECES), random.Random(1)
    letters = "ab ▁c\né\U00010348thein\r;){"
    for _ in range(3000):
        text = "".join(draw.choices(letters, k=draw.randint(0, 25)))
        assert coder.encode(text) == coder.model.encode(text)


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups(spark):
    docs = table(spark)
    rows = simhash.near_duplicates(docs).collect()
    prints = {(r["doc_id"], r["simhash"]) for r in rows}
    want = [(d, plain_fingerprint(t)) for d, t in pairs(docs, "text")]
    assert prints == {(d, x - (1 << 64) if x >> 63 else x) for d, x in want}
    root = list(range(len(want)))
    for _ in want:
        for i, (_, a) in enumerate(want):
            for j, (_, b) in enumerate(want):
                if (a ^ b).bit_count() <= 3:
                    root[i] = root[j] = min(root[i], root[j])
    least = {}
    for r, (d, _) in zip(root, want, strict=True):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    assert Counter((r["doc_id"], r["component_id"]) for r in rows) == Counter(
        (d, least.get(r)) for r, (d, _) in zip(root, want, strict=True))
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(root))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("distance", [2, 3, 4])
def test_near_links_hold_all_pairs_together(spark, distance, monkeypatch):
    draw = random.Random(distance)
    seeds = [draw.getrandbits(64) for _ in range(15)]
    prints = set(seeds)
    for s in seeds * 4:
        for b in draw.sample(range(64), draw.randint(1, distance + 1)):
            s ^= 1 << b
        prints.add(s)
    meeting = simhash._Meeting(distance)
    monkeypatch.setattr(simhash, "HELD", 5_000)
    masks = [simhash._masks(20, distance // 2 + (distance & 1) * (p.bit_count() & 1)) for p in (0, 1)]
    rows = sorted(((p >> 44) ^ int(m), p) for p in prints for m in masks[p.bit_count() & 1])
    found = []
    for lead in {r[0] for r in rows}:
        own = np.array([p for q, p in rows if q == lead], np.uint64)
        found += meeting.links(
            own, np.uint64(lead << 44) | (own & np.uint64((1 << 44) - 1)), 44)
    linked = {frozenset(x) for block in found for x in block.tolist()}
    assert all((a ^ b).bit_count() <= distance for a, b in map(tuple, linked))
    root = {p: p for p in prints}
    for _ in prints:
        for a, b in map(tuple, linked):
            root[a] = root[b] = min(root[a], root[b])
    for a in prints:
        assert all(root[a] == root[b] for b in prints if (a ^ b).bit_count() <= distance)


@pytest.mark.parametrize("distance", [2, 3])
def test_crowded_values_are_split(spark, distance):
    draw = random.Random(distance)
    close = {0x123456789ABCDEF0 ^ sum(1 << b for b in draw.sample(range(40), draw.randint(0, 3))) for _ in range(400)}
    prints = sorted({x - (1 << 64) if x >> 63 else x for x in close | {draw.getrandbits(64) for _ in range(200)}})
    table = spark.createDataFrame([(p,) for p in prints], "print long")
    for crowd in (100, 10_000_000):
        linked = dict(components(simhash.near_links(table, "print", distance, crowd), "a", "b").collect())
        root = {p: p for p in prints}
        order = [p for p in prints]
        for _ in range(8):
            for a in order:
                for b in order:
                    if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= distance:
                        root[a] = root[b] = min(root[a], root[b])
        assert {p: linked.get(p, p) for p in prints} == root
    assert simhash._width(10**10, 3) > simhash._width(10**6, 3) == simhash.LEADING


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    found = dict(components(links, "a", "b").collect())
    assert found == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}
    assert components(links.limit(0), "a", "b").count() == 0


def test_license_scan(spark):
    docs = table(spark)
    rows = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    for d, text in pairs(docs, "text"):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                           re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        base = sorted((i, label) for phrase, label in licenses.BASE_PHRASES.items()
                      for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split())
        assert rows[d]["n_words"] == len(words)
        assert sorted((x["start"], x["label"]) for x in rows[d]["base"]) == base
    found = [x["label"] for x in rows[5]["detections"]]
    assert found == ["gpl", "mit", "cc-by-sa"]
    # The statement holds the name, which says nothing of its own.
    assert [(x["start"], x["stop"], x["label"]) for x in rows[11]["detections"]] == [
        (0, 8, "apache-2.0"), (8, 11, "all-rights-reserved")]


def spelled(parsed, whole):
    """Texts a pattern matches: every alternative, with all optional parts or none."""
    texts = [""]
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            more = [chr(value)]
        elif name == "IN":
            more = [chr(value[0][1] if str(value[0][0]) == "LITERAL" else value[0][1][0])]
        elif name == "BRANCH":
            more = [t for branch in value[1] for t in spelled(branch, whole)]
        elif name == "SUBPATTERN":
            more = spelled(value[-1], whole)
        else:
            assert name == "MAX_REPEAT" and value[:2] == (0, 1)
            more = spelled(value[2], whole) if whole else [""]
        texts = [a + b for a in texts for b in more]
    return texts


def plain_detections(text):
    """What all rules find with no keyword asked for, without what lies in others as good."""
    words, found = f" {text} ", []
    for rank, r in enumerate(licenses.RULES):
        for m in re.finditer(f" {r.pattern}(?= )", words):
            start = words[:m.start()].count(" ")
            found.append((start, -start - m[0].count(" "), r.priority, rank, r.label))
    found, kept = sorted(found), []
    for start, before, priority, _, label in found:
        if not any(p <= priority and b <= before for p, b, _ in kept):
            kept.append((priority, before, label))
    return [label for _, _, label in kept]


def test_every_license_rule_fires(spark):
    texts = []
    for r in licenses.RULES:
        own = [t for whole in (False, True) for t in spelled(re._parser.parse(r.pattern), whole)]
        assert all(r.keyword in t for t in own), r
        texts += own
    texts = sorted(set(texts))
    rows = licenses.scan(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert len(rows) == len(texts) > len(licenses.RULES)
    for row in rows:
        assert [x["label"] for x in row["detections"]] == plain_detections(row["text"]) != [], row["text"]
    cases = {
        "Licensed under Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License":
            "cc-by-nc-sa", "Creative Commons Zero": "cc0", "SPDX-License-Identifier: MIT": "mit",
        "// SPDX-License-Identifier: Apache-2.0": "apache-2.0", "dedicated to the public domain": "public-domain",
        "SPDX-License-Identifier: GPL-3.0-only": "gpl-3.0", "spdx-license-identifier: BSD-3-Clause": "bsd-3"}
    cases |= {
        "GPLv2": "gpl-2.0", "GPL v3 license": "gpl-3.0", "LGPL-2.1": "lgpl-2.1", "Apache-2.0": "apache-2.0",
        "Licensed under Apache 2.0": "apache-2.0", "MIT licence": "mit", "MPL 2.0": "mpl-2.0",
        "BSD 3-Clause License": "bsd-3", "GNU AGPLv3": "agpl-3.0",
        "Attribution-NonCommercial-NoDerivs 3.0": "cc-by-nc-nd", "Attribution Non-Commercial": "cc-by-nc",
        "Creative Commons Attribution Non-Commercial": "cc-by-nc",
        "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted": "isc",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version.": {"gpl", "gpl-3.0"}}
    for row in licenses.scan(spark.createDataFrame([(t,) for t in cases], "text string")).collect():
        want = cases[row["text"]]
        assert {x["label"] for x in row["detections"]} == (want if isinstance(want, set) else {want}), row["text"]
    assert len(licenses.RULES) > 400
    assert licenses.scan(table(spark).limit(0)).count() == 0


def test_token_files(spark):
    docs, folder = table(spark), staging_path(spark, "tokens")
    manifest = token_files.write_files(docs, folder, WORDS, end_id=1, length=16)
    rows = token_files.read_documents(spark, manifest, folder).collect()
    library, at = Tokenizer.from_file(WORDS), 0
    order = sorted(pairs(docs, "text"), key=lambda r: (r[0] is not None, r[0] or 0))
    for (d, text), row in zip(order, sorted(rows, key=lambda r: r["start"]), strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert tuple(row) == (d, at, len(ids), crc)
        at += len(ids)
    store, top = token_files.open_store(folder)
    first = manifest.orderBy("shard").first()
    ids, mask = token_files.read_sequence(f"{top}/{first['file']}", 0)
    assert len(ids) == len(mask) == 16


def test_every_sequence_of_a_shard(tmp_path):
    length, dtype, path = 4, np.dtype("<u2"), str(tmp_path / "shard.arrow")
    sizes = [4 * 65 + 1, 3, 4 * 200, 1, 4 * 64, 5]
    with open(path, "wb") as sink:
        writer = token_files._ShardWriter(sink, length, dtype)
        stream = np.arange(sum(sizes), dtype=dtype)
        for i, stop in enumerate(np.cumsum(sizes)):
            writer.add(i, stream[stop - sizes[i]:stop])
        writer.close()
    for number in range(-(-len(stream) // length)):
        ids, mask = token_files.read_sequence(path, number)
        assert ids[mask].tolist() == stream[number * length:(number + 1) * length].tolist()
    found = list(token_files._documents(*token_files.open_store(path)))
    assert [(n, sum(map(len, parts))) for n, parts in found] == list(enumerate(sizes))


def test_word_encoder_on_random_texts(monkeypatch):
    coder, draw = token_files.WordEncoder(WORDS), random.Random(3)
    letters = ["a", "B", " ", "\n", "\x1c", "\x85", "\xa0", "é", "ß", "İ", "ı", "Σ", "1", "½", "漢", "́",
               "'", "'s", "!", "<|endoftext|>", "…", "\t", "ª", "\xad", "\x00", "thing", "Ⱥ", "ⱥ", "<|", "ǅ"]
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 12))) for _ in range(4000)]
    want = [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for size in (400_000, 50):  # and with memos that forget all the time
        coder.of_word.size = coder.of_piece.size = size
        for step in (1, 100):
            for i in range(0, len(texts), step):
                for ids, packed in zip(want[i:i + step], coder.packed(texts[i:i + step]), strict=True):
                    assert np.frombuffer(packed, coder.dtype).tolist() == ids


def test_a_word_of_many_texts_is_looked_up_once(monkeypatch):
    coder, asked = token_files.WordEncoder(WORDS), []
    plain = token_files._Memo.found
    monkeypatch.setattr(token_files._Memo, "found", lambda self, keys, find: (
        asked.extend(keys if self is coder.of_word else []), plain(self, keys, find))[1])
    texts = ["The thing, the Thing.\n", "", "a thing,\xa0the 漢字 thing"] * 50
    want = [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(p, coder.dtype).tolist() for p in coder.packed(texts)] == want
    assert len(asked) == len(set(asked)) < 10


def test_decontamination(spark):
    draw = random.Random(4)
    word = lambda: draw.choice("abcdefgh")
    items = {str(i): " ".join(word() for _ in range(draw.choice([2, 5, 13, 20]))) for i in range(8)}
    items |= {"none": "?!", "10": items["3"]}
    texts = [" ".join(word() for _ in range(draw.randint(0, 60))) for _ in range(40)]
    texts += [f"x, {items[k].upper()}. {texts[0]}" for k in ("1", "3")] + TEXTS
    docs = table(spark, texts)
    bench = spark.createDataFrame([*items.items(), (None, None)], "item_id string, text string")
    found = {r["doc_id"]: r for r in decontaminate.find_benchmark(docs, bench, block_bytes=40).collect()}
    for d, text in pairs(docs, "text"):
        own = re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        hit, met = set(), set()
        for name, item in items.items():
            ws = re.findall("[0-9a-z]+", item)
            size = min(13, len(ws))
            spans = {tuple(ws[i:i + size]) for i in range(len(ws) - size + 1)} if ws else set()
            for i in range(len(own) - size + 1):
                if tuple(own[i:i + size]) in spans:
                    hit |= set(range(i, i + size))
                    met.add(name)
        assert (found[d]["n_words"], found[d]["n_hit"], found[d]["items"]) == (
            len(own), len(hit), sorted(met))
    left = decontaminate.remove_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert decontaminate.find_benchmark(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_benchmark_blocks_are_built_once_in_a_worker(monkeypatch):
    class Sent:
        def __init__(self, items):
            self.value = items

    built = []
    plain = decontaminate._Block.__init__
    monkeypatch.setattr(decontaminate._Block, "__init__", lambda self, *a: built.append(1) or plain(self, *a))
    monkeypatch.setattr(decontaminate, "_built", decontaminate.OrderedDict())
    sent = [(i, Sent([(str(i), f"word{i} of the item {i}".encode())])) for i in range(decontaminate.BUILT)]
    for _ in range(5):
        rows = decontaminate.find_in_shard(
            [b"a word3 of the item 3, so", b"none"], (decontaminate._block(n, s, 13) for n, s in sent))
        assert [(r[1], r[3]) for r in rows] == [(5, ["3"]), (0, [])]
    assert len(built) == decontaminate.BUILT
    for n, s in [*sent, (99, Sent([]))]:  # one more than there is room for
        decontaminate._block(n, s, 13)
    assert len(decontaminate._built) == decontaminate.BUILT


def test_an_encoder_of_few_chunks_gives_the_same_ids():
    few, many = sentencepiece_codec.PrefixEncoder(PIECES, 5), sentencepiece_codec.encoder(PIECES)
    for text in [t or "" for t in TEXTS] * 2:
        assert few.packed(text) == many.packed(text)
        assert len(few.chunks) <= 5 and len(few.older) <= 5


def test_words_of_a_shard_are_held_as_numbers():
    draw = random.Random(8)
    known = [f"word{i}" for i in range(3000)]
    texts = [" ".join(draw.choices(known, k=1000)).encode() for _ in range(300)]
    block = decontaminate._Block([("1", b"word1 word2 of the item"), ("2", texts[7][:200])], 13)
    tracemalloc.start()
    rows = decontaminate.find_in_shard(texts, [block])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [i for i, r in enumerate(rows) if r[3] == ["2"]] == [7]
    assert peak < 6 * sum(map(len, texts))


def test_texts_are_taken_a_bounded_part_at_a_time(spark):
    docs = spark.range(12, numPartitions=1).selectExpr(
        "id", "CASE WHEN id = 5 THEN NULL WHEN id = 7 THEN repeat('é', 2000000) ELSE repeat('x', 700000) END AS text")
    seen = frames.over_texts(docs, "text", "n long, at_once long", lambda texts: [
        (len(t), sum(map(len, texts))) for t in texts])
    rows = {r["id"]: (r["n"], r["at_once"]) for r in seen.collect()}
    assert {i: n for i, (n, _) in rows.items()} == {
        i: 0 if i == 5 else 4_000_000 if i == 7 else 700_000 for i in range(12)}
    assert all(n <= frames.AT_ONCE for i, (_, n) in rows.items() if i != 7) and rows[7][1] == 4_000_000


def test_many_benchmark_blocks(spark):
    docs = spark.range(300, numPartitions=2).selectExpr("id AS doc_id", "concat('so item', id, ' stands here now') AS text")
    bench = spark.range(40).selectExpr("cast(id AS string) AS item_id", "concat('item', 3 * id, ' stands') AS text")
    found = decontaminate.find_benchmark(docs, bench, block_bytes=50)
    rows = {r["doc_id"]: r["items"] for r in found.collect()}
    assert rows == {i: [str(i // 3)] if i % 3 == 0 and i < 120 else [] for i in range(300)}


def test_quality_model(spark):
    good = [f"The {a} of the {b} was seen again. It went on for a long while near {c}, and so they said it."
            " Nobody knew what it was. We left." for a in "abcdef" for b in "ghijk" for c in "lmnop"]
    bad = [" ".join(f"W{x}{y}!!" for y in range(30)) for x in range(30)]
    toxic = [g + " You vequ" + "abcdef"[i % 6] + " fool." for i, g in enumerate(good[:40])]
    texts = good + bad + toxic + ["", None, LONG]
    docs = table(spark, texts)
    labels = spark.createDataFrame(
        [(i, 1, int(len(good) + len(bad) <= i < len(texts) - 3)) for i in range(len(texts))],
        "doc_id long, quality int, toxic int")
    rows = {r["doc_id"]: r for r in quality_model.classify(docs, labels).collect()}
    assert np.mean([rows[i]["kept"] for i in range(1, len(good))]) > 0.95
    assert np.mean([rows[i]["kept"] for i in range(len(good), len(good) + len(bad))]) < 0.05
    assert np.mean([rows[len(good) + len(bad) + i]["toxicity"] > 0.5 for i in range(40)]) > 0.9
    assert quality_model.classify(docs.limit(0), labels).count() == 0


def test_word_lists_are_read_from_labelled_rows_only(spark, monkeypatch):
    plans, stage = [], quality_model.stage

    def kept(df, name, by=None):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, name, by)

    monkeypatch.setattr(quality_model, "stage", kept)
    docs = table(spark, [*(f"vequ{i} fool of word{i}" for i in range(40)), *["a word of them"] * 160, "", None])
    labels = spark.createDataFrame([(i, 1, int(i < 40)) for i in range(180)] + [(200, 1, 0), (201, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    lists = quality_model.learn_lists(docs, labels)
    assert (lists.words, lists.beginnings) == ({b"fool"}, {b"vequ", b"fool"})
    # Above the join with the labelled rows, and nowhere below it.
    assert [p.count("ArrowEvalPython") for p in plans] == [1]


def test_votes_and_features_of_texts_taken_together():
    lists = quality_model.Lists(frozenset({b"fool"}), frozenset({b"vequ", b"wretch"}))
    texts = [(t or "").encode() for t in TEXTS] + [
        b"Fool!", b"a vequ", b"vequila", b"veq", b"wretc", b"wretched idiot", b"A FOOL " * 30, b"\xff x"]
    found = list(quality_model._features(texts, lists))
    assert [f[:2] for f in found] == quality_model._votes(texts, lists)
    for text, (bad, toxic, buckets) in zip(texts, found, strict=True):
        words, form = set(re.findall(rb"[0-9a-z\x80-\xff]+", text.lower())), quality_model._form(text)
        heads = {w[:n] for w in words for n in (4, 6, 8) if len(w) >= n}
        says = [bool(words & {b"idiot"}), b"fool" in words, bool(heads & lists.beginnings)]
        assert toxic == sum(1 << i for i, s in enumerate([*says, not any(says)]) if s)
        names = [*words, *(b"^" + h for h in heads), *(f"={k}{min(9, int(10 * v))}".encode() for k, v in form.items())]
        names += [b"=bad%d" % i for i in range(8) if bad >> i & 1] + [b"=toxic%d" % i for i in range(4) if toxic >> i & 1]
        assert buckets.tolist() == sorted({zlib.crc32(n) & (quality_model.BUCKETS - 1) for n in names})


def test_line_templates(spark):
    same = "Page {} of the county record, kept by the clerk"
    texts = [f"first {chr(97 + i) * 3}\n{same.format(i)}\nown words {chr(98 + i) * 4}" for i in range(8)]
    docs = table(spark, texts + [None, "", "Page one of another thing"])
    rows = line_templates.drop_recurring(docs, n_dropped="lost")
    assert set(docs.columns) | {"lost"} == set(rows.columns) and rows.count() == docs.count()
    kept = [r for r in rows.collect() if r["text"] and "county record" in r["text"]]
    # One document keeps the line; everything else stays.
    assert len(kept) == 1
    assert sum(r["lost"] for r in rows.collect()) == 8
    assert all("own words" in r["text"] for r in rows.collect() if r["doc_id"] is not None and r["doc_id"] < 8)
    assert line_templates.drop_recurring(docs.limit(0)).count() == 0


def dropped(spark, texts):
    rows = line_templates.drop_recurring(table(spark, texts)).where("doc_id is not null").collect()
    return {r["doc_id"]: (r["text"], r["n_dropped"]) for r in rows}


def test_lines_alike_in_their_opening_only(spark):
    draw = random.Random(7)
    other = lambda n: " ".join("".join(draw.choices("abcdefgh", k=6)) for _ in range(n))
    texts = ["start"] + [f"Was seen that {other(n)}" for n in (1, 2, 9) for _ in range(12)]
    assert dropped(spark, texts) == {i: (t, 0) for i, t in enumerate(texts)}


def test_templates_that_share_a_leaf(spark):
    hot = "Sent to the office by a clerk of this county"
    rare = "Sent to the paper with love from our old readers"
    names = ["".join(random.Random(i).choices("abcdefgh", k=6)) for i in range(16)]
    texts = ["start"] + [hot] * 30 + [rare] * 7
    texts += [f"Sent to the archive where {n} keeps all such letters" for n in names[:8]]
    texts += [f"Sent to the museum under {n} for many more years" for n in names[8:]]
    rows = dropped(spark, texts)
    # The first line of each of the four stays, and no other.
    assert [i for i, (t, n) in sorted(rows.items()) if t and not n] == [0, 1, 31, 38, 46]
    assert sum(n for _, n in rows.values()) == len(texts) - 5


def test_long_lines_recur_from_two_documents(spark):
    long = " ".join(f"word{chr(97 + i)}" for i in range(25))
    texts = ["start", long, f"own\n  {long} ", f"{long} 1", f"{long} 2", "short line", "short line"]
    rows = dropped(spark, texts)
    assert rows[2] == ("own", 1)
    assert all(rows[i] == (t, 0) for i, t in enumerate(texts) if i != 2)


def test_wording_of_templates(spark):
    names = ["".join(random.Random(i).choices("abcdefgh", k=6)) for i in range(16)]
    long = " ".join(f"word{chr(97 + i)}" for i in range(24)) + " 12"
    texts = [f"Sent to the archive where {n} keeps page {i} of all" for i, n in enumerate(names)]
    texts += ["The end 7", long, long] + ["Page 3 of 4 here"] * 6
    found, belongs = line_templates.templates(table(spark, texts))
    rows = {r["wording"]: r["n_documents"] for r in found.collect()}
    # The table repeats its first row.
    assert rows == {"Sent to the archive where <*> keeps page <*> of all": 17, long: 2, "Page 3 of 4 here": 6}
    assert belongs.count() == 25


def plain_line_dedup(texts):
    """Texts without recurring lines, by the rules alone: every group of lines is looked through."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    hash64 = lambda t, seed=42: signed(xxhash.xxh64_intdigest(t.encode(), seed))
    second = xxhash.xxh64_intdigest(b"line", 42)
    name = lambda t: (hash64(t), hash64(t, second))
    lines, rows_of, seen, count = {}, {}, {}, Counter()
    for place, text in enumerate(texts):
        for i, line in enumerate((text or "").split("\n") if text is not None else []):
            single = re.sub(r"[\x00-\x20]+", " ", line).strip(" ")
            if single:
                masked = re.sub(r"[^ ]*[0-9][^ ]*", "<*>", single)
                lines[place, i] = single, masked
                rows_of.setdefault(masked, set()).add(place)
                seen.setdefault(single, set()).add(place)
                count[masked] += 1
    leaves = {}
    for masked in count:
        tokens = masked.split(" ")
        leaves.setdefault((len(tokens), *tokens[:3]), []).append(masked)
    template, members = {}, {}
    for leaf, own in leaves.items():
        rows = set().union(*(rows_of[m] for m in own))
        own = [m for m in own if set(m.split(" ")) != {"<*>"}]
        if len(rows) < 2 or sum(count[m] for m in leaves[leaf]) < 6:
            continue
        recurs = {m: len(rows_of[m]) >= 6 for m in own}
        template |= {m: m for m in own if recurs[m]}
        n = leaf[0]
        if n <= 3:
            continue
        needed = math.ceil(n * 0.7 - 1e-9)
        bands, groups = min(n - 3, n - needed + 1), {}
        for m in own:
            tokens = m.split(" ")
            for wide in (1, 2):
                for first in range(bands):
                    if first + wide > bands or wide == 2 and bands <= 2:
                        continue
                    a, b = first * (n - 3) // bands, (first + wide) * (n - 3) // bands
                    band = tuple(tokens[3 + a:3 + b])
                    if "<*>" not in band:
                        groups.setdefault((first, wide, band), []).append(m)
        like = {}
        for group in groups.values():
            for kind in (True, False):
                said = max((m for m in group if recurs[m] == kind), key=lambda m: (count[m], name(m)), default=None)
                for m in group if said and len(group) > 1 else []:
                    same = [x == y != "<*>" for x, y in zip(m.split(" "), said.split(" "), strict=True)]
                    if not recurs[m] and sum(same) >= needed and any(same[3:]):
                        like.setdefault(m, set()).add(said)
        for m, said in like.items():
            for t in said:
                members.setdefault(t, set()).add(m)
        rows = {t: len(set().union(*(rows_of[m] for m in own))) for t, own in members.items()}
        for m, said in like.items():
            best = max(((recurs[t], rows[t] if not recurs[t] and rows[t] >= 6 else -1, name(t), t) for t in said
                        if recurs[t] or rows[t] >= 6), default=None)
            if best:
                template[m] = best[3]
    where = {}
    for (place, i), (single, masked) in sorted(lines.items()):
        own = template.get(masked)
        if own is None and len(single.split(" ")) >= 20 and len(seen[single]) > 1:
            own = single
        if own is not None:
            where.setdefault(own, []).append((place, i))
    gone = {(p, i) for own in where.values() for p, i in own if p != own[0][0]}
    left = []
    for place, text in enumerate(texts):
        lost = {i for p, i in gone if p == place} if text is not None else set()
        left.append((text if not lost else "\n".join(
            line for i, line in enumerate(text.split("\n")) if i not in lost), len(lost)))
    return left


def test_line_dedup_against_plain_rules(spark):
    draw = random.Random(11)
    words = "clerk county sent paper letter archive museum office the a of by for kept".split()
    base = [" ".join(draw.choices(words, k=k)) for k in (3, 4, 5, 7, 9, 12, 25) for _ in range(3)]
    base += [f"Sent to the {' '.join(draw.choices(words, k=6))}" for _ in range(6)]

    def varied(line):
        tokens = line.split(" ")
        for _ in range(draw.choice([0, 0, 1, 2, 4])):
            tokens[draw.randrange(len(tokens))] = draw.choice([*words, "x7", "12", "page3"])
        return draw.choice(["", " "]) + " ".join(tokens)

    texts = ["\n".join(varied(draw.choice(base)) for _ in range(draw.randint(0, 8))) for _ in range(150)]
    docs = table(spark, texts + [None, "", "1 2 3", "1 2 3"] + texts[:3])
    docs = docs.coalesce(1)
    rows = line_templates.drop_recurring(docs).collect()
    want = plain_line_dedup([r["text"] for r in docs.collect()])
    assert sum(n for _, n in want) > 200
    assert [(r["text"], r["n_dropped"]) for r in rows] == want


def test_a_line_finds_its_template_behind_a_hot_one(spark):
    hot, rare = "Sent to the m n o p q f g", "Sent to the a b c d e f g"
    # Like the rare line at 7 places of 10, and sharing with it only a band for which the hot one speaks.
    behind = "Sent to the x y c z e f g"
    texts = ["start"] + [hot] * 30 + [rare] * 7 + [behind, "Sent to the x y c z v w g"]
    rows = dropped(spark, texts)
    assert rows[38] == ("", 1) and rows[39] == (texts[39], 0)


def alike_everywhere(texts):
    """Lines of one-line texts that go if every pair of them is looked at, and how many speakers miss."""
    rows_of = {}
    for place, text in enumerate(texts):
        rows_of.setdefault(text, set()).add(place)
    leaves = {}
    for line in rows_of:
        leaves.setdefault((len(line.split(" ")), *line.split(" ")[:3]), []).append(line)
    gone = set()
    for (n, *_), own in leaves.items():
        tokens = {m: m.split(" ") for m in own}

        def like(a, b):
            same = [x == y for x, y in zip(tokens[a], tokens[b], strict=True)]
            return sum(same) >= math.ceil(n * 0.7 - 1e-9) and any(same[3:])

        recurs = {m for m in own if len(rows_of[m]) >= 6}
        rows = {t: len({p for m in own if m not in recurs and like(m, t) for p in rows_of[m]}) for t in own}
        gone |= recurs | {m for m in own if any(like(m, t) and (t in recurs or rows[t] >= 6) for t in own)}
    return {p for m in gone for p in rows_of[m]}


def test_no_line_stays_that_is_like_a_recurring_one(spark, monkeypatch):
    draw = random.Random(3)
    texts = [f"Sent to the {' '.join(draw.choices('abc', k=draw.choice([5, 7, 9])))}" for _ in range(160)]
    texts += [draw.choice(texts[:6]) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    want = alike_everywhere(texts)
    for compared in (line_templates.COMPARED, 3):
        monkeypatch.setattr(line_templates, "COMPARED", compared)
        rows = line_templates.drop_recurring(docs, keep_first=False).collect()
        assert {r["doc_id"] for r in rows if r["n_dropped"]} == want
    # Those that speak for a group find fewer.
    monkeypatch.setattr(line_templates, "_neighbours", lambda keys, lines: line_templates._spoken(keys).limit(0))
    rows = line_templates.drop_recurring(docs, keep_first=False).collect()
    assert {r["doc_id"] for r in rows if r["n_dropped"]} < want < set(range(len(texts)))


def test_lines_with_any_blanks_between_tokens(spark):
    line = "one  two\tthree \x00 four\r five12 6six se7en\x1f"
    texts = ["\n".join((f" {line}", "", " \t ", f"own{i}")) for i in range(2)] + [line.replace("  ", " ")] * 4
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    lines = line_templates._lines(docs, "text").orderBy("place", "line_no").collect()
    assert [(r["line_no"], r["single"], r["masked"]) for r in lines[:2]] == [
        (0, "one two three four five12 6six se7en", "one two three four <*> <*> <*>"), (3, "own0", "<*>")]
    rows = line_templates.drop_recurring(docs).orderBy("doc_id").collect()
    assert [r["n_dropped"] for r in rows] == [0, 1, 1, 1, 1, 1] and rows[1]["text"] == "\n \t \nown1"


def test_quality_ledger(spark):
    docs = table(spark)
    written = quality_rules.ledger(docs)
    rows = {r["doc_id"]: r for r in written.collect()}
    for d, text in pairs(docs, "text"):
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
        again = {i + j for i in range(len(words) - 7) for j in range(8) if windows[tuple(words[i:i + 8])] > 1}
        assert (rows[d]["n_words"], rows[d]["word_chars"], rows[d]["n_repeat_words"]) == (
            len(words), sum(map(len, words)), len(again))
    counted = {r["rule"]: r for r in quality_rules.ablations(written, quality_rules.STRICT).collect()}
    assert counted["few_words"]["n_failed"] == sum(1 for r in written.collect() if r["failed"] & 1)


def test_main_text(spark):
    page = ("<html><head><title>T</title><style>p{}</style></head><body><nav><a href=x>Menu, long. text.</a></nav>"
            "<div class='ad'>Buy now, it is good. Really good. Yes.</div><article><h1>Head &amp; line</h1>"
            "<p><b>Bold.<br><p>First   para,\n with <a href=y>a link</a>.</p><![ x ]><p>Second &eacute;."
            "<aside>Side note.</aside><div id=comments>Nice post!</div></article><footer>&copy; us</footer>")
    pages = spark.createDataFrame([(1, page, "n"), (2, None, "n"), (3, "", "n"), (4, "<p>" * 3000 + "x", "n")],
                                  "page_id long, html string, text string")
    rows = {r["page_id"]: r for r in html_content.extract(pages).collect()}
    assert rows[1]["text"] == "Head & line\nBold.\nFirst para, with a link.\nSecond é."
    assert rows[2]["text"] == rows[3]["text"] == "" and rows[4]["text"] == "x"
    assert rows[1]["n_chars"] == len(rows[1]["text"]) and html.unescape("&copy;") == "©"


def test_whole_articles():
    long = "".join(f"<p>Paragraph {i}, long and dull, goes on. {'And on, it says. ' * 20}</p>" for i in range(9))
    boxed = html_content.main_text(f"<article><h1>Head</h1><p>Short lead.</p><div>{long}</div></article>")
    assert boxed.startswith("Head\nShort lead.\nParagraph 0") and boxed.count("\n") == 10
    inner = "<h1>Head</h1><p>One, two. Three.</p><div class=ad>Buy, now.</div>"
    side = "<div class=sidebar>Some box, it says.</div><div id=comments><article><p>Nice, I say.</article></div>"
    for wrapper in ("page has-sidebar", "with-nav", "content-sidebar", "page widget"):
        for tag in ("article", "main"):
            page = f"<body><div class='{wrapper}'><{tag}>{inner}</{tag}>{side}</div>"
            assert html_content.main_text(page) == "Head\nOne, two. Three."
    assert html_content.main_text(f"<div class='search page'>{long}</div>{side}").startswith("Paragraph 0")
    assert html_content.main_text(f"<div><p>Own, text. Here.</div>{side * 9}") == "Own, text. Here."
    teaser = "<div class=sidebar><article><p>Read more, now.</article></div>"
    assert html_content.main_text(f"<div><p>Own, text. Here it is.</div>{teaser}") == "Own, text. Here it is."


def test_article_parts_named_like_boxes():
    told = "<h2 id=the-search-for-life>The search</h2><h3 id=notice>Notice</h3><p id=related-work>Related, here.</p>"
    page = f"<article><header><h1>Title</h1><p>By Ann.</p></header>{told}<p class=market-share>Shares, up.</p>{{}}</article>"
    want = "Title\nBy Ann.\nThe search\nNotice\nRelated, here.\nShares, up."
    assert html_content.main_text(page.format("")) == want
    real = "".join("Real, text. " for _ in range(40)).strip()
    boxes = ("<div class=ad>" + real + "</div><div class=search-box>Go</div><div id=comments><p>Nice, I say.</p></div>"
             f"<div class=market-share><p>{real}</p></div><section id=search><p>{real}</p></section><footer>f</footer>")
    assert html_content.main_text(page.format(boxes)) == f"{want}\n{real}\n{real}"
    assert html_content.main_text("<header><h1>Site</h1></header><article><p>Text, it is.</article>") == "Text, it is."


def test_heading_and_lead_outside_the_body_box():
    long = "".join(f"<p>Paragraph {i}, long and dull, goes on. {'And on, it says. ' * 20}</p>" for i in range(9))
    lists = "<ul><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul>"
    for page in (f"<div><h1>Head</h1><p>Short lead.</p><div class=body>{long}</div></div>",
                 f"<div id=post><h2>Head</h2><p>Short lead.</p><section>{long}</section></div>",
                 f"<div>{lists}<h1>Head</h1><div>Short lead.</div><div>{long}</div><div>(c) us</div></div>"):
        text = html_content.main_text(f"<body><nav>Menu, it is.</nav>{page}<div>{lists}</div>")
        assert text.startswith("Head\nShort lead.\nParagraph 0") and text.count("\n") == 10
    assert html_content.main_text("<article><a href=x>One link only</a></article>") == "One link only"
    assert html_content.main_text("Just text &amp; more") == "Just text & more"
    assert html_content.main_text(f"<body>{lists}") == ""


@pytest.mark.parametrize("page", [
    "<article>" * 3000 + "x", "<div>" * 20_000 + "x", "<div class=ad>" * 20_000 + "x" + "</span>" * 20_000,
    "<b>" * 20_000 + "<li>x" * 20_000, "<article class=x>" * 3000 + "<p>x" * 3000, "<p>" * 30_000 + "x"])
def test_deep_pages_take_little_time(page):
    start = time.process_time()
    html_content.main_text(page)
    assert time.process_time() - start < 3


def plain_article(page):
    """The article of a given page: what its headings and paragraphs hold."""
    inner = re.sub("<!--.*?-->", "", re.search("<article>(.*?)</article>", page, re.S)[1], flags=re.S)
    blocks = re.split("</?(?:h1|p)[^>]*>", re.sub("<br ?/?>", " ", inner))
    texts = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


def test_articles_of_all_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    pages = pages.unionByName(pages.limit(3)).withColumn("Text", pages.url)
    rows = html_content.extract(pages).collect()
    assert len(rows) == pages.count() > 250
    for row in rows:
        assert row["text"] == plain_article(row["html"]) and row["n_chars"] == len(row["text"])
    assert html_content.extract(pages.limit(0)).count() == 0


def plain_repeats(texts, window):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + window] for d in data for i in range(len(d) - window + 1))
    found = []
    for d in data:
        out = bytearray(len(d))
        for i in range(len(d) - window + 1):
            if seen[d[i:i + window]] > 1:
                out[i:i + window] = b"\1" * window
        kept = bytes(x for x, gone in zip(d, out, strict=True) if not gone)
        spans = sum(1 for i, x in enumerate(out) if x and (i == 0 or not out[i - 1]))
        found.append((len(d), sum(out), spans, hashlib.sha256(kept).hexdigest()))
    return found


@pytest.mark.parametrize("crowd", [20_000, 1])
def test_repeated_strings(spark, crowd, monkeypatch):
    # The texts are short, so blind tries have to begin early.
    monkeypatch.setattr(suffix_dedup.sort_suffixes, "__defaults__", (24,))
    draw = random.Random(5)
    noise = lambda n: "".join(draw.choices("abcé \n", k=n))
    passage, other = noise(90), noise(60)
    texts = [noise(30) + passage + noise(40), passage[20:] + noise(50), noise(5) + passage[:70] + other,
             other + other, "a" * 200, None, "", "short", other[3:55] + noise(20) + passage[10:60]]
    docs = table(spark, texts)
    found = suffix_dedup.repeated_windows(
        [(passage + t)[:80].encode() for t in texts[:3] for _ in range(2)], np.full(6, 4), np.full(6, 5), 40, 16)
    assert all(f == [(0, 5)] for f in found)
    rows = suffix_dedup.remove_repeats(docs, window=40, gram=16, crowd=crowd).collect()
    got = Counter((r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in rows)
    assert got == Counter(plain_repeats([r["text"] for r in docs.collect()], 40))
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_repeated_strings_of_the_full_length(spark):
    """The query's own setting over whole documents, with most marks split, too."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r["text"] for r in docs.collect()]
    base = max(texts, key=lambda t: len(t or '') if len(t or '') < 5000 else 0)
    near = [base[:i * 11] + "#" + base[i * 11:700 + i] for i in range(40)]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(
        [(-i, t) for i, t in enumerate(near)], "doc_id long, text string"))
    want = Counter(plain_repeats([r["text"] for r in docs.collect()], 400))
    for crowd in (suffix_dedup.CROWD, 2):
        rows = suffix_dedup.remove_repeats(docs, crowd=crowd).collect()
        assert Counter((r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest())
                       for r in rows) == want


def test_deep_shallow_order():
    draw = random.Random(6)
    strings = [bytes(draw.choices(b"ab", k=draw.randint(0, 9))) for _ in range(200)]
    strings += [b"x" * 300 + bytes(draw.choices(b"ab", k=draw.randint(0, 5))) for _ in range(100)]
    order, common = suffix_dedup.sort_suffixes(strings, shallow=8)
    ordered = [strings[i] for i in order]
    assert ordered == sorted(strings)
    for a, b, n in zip(ordered, ordered[1:], common[1:], strict=False):
        assert n == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
