"""All stages of the pipeline against plain Python, stage after stage."""

import hashlib
import re
from collections import Counter

import public_tokenizers
import sentencepiece

import corpus_pipeline
from test_operators import LONG, TEXTS, plain_fingerprint, plain_line_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, Failed string, n_dropped int, place int"


def plain_quality(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    again = {i + j for i in range(len(words) - 7) for j in range(8) if windows[tuple(words[i:i + 8])] > 1}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    chars, n = sum(map(len, words)), len(words)
    return not (
        n < 20 or 100 * len(again) > 30 * n or 10 * len(re.findall("[#*$%&|<>]", text)) > 3 * n
        or len(lines) >= 4 and 2 * (len(lines) - len(set(lines))) > len(lines) or chars < 2 * n or chars > 20 * n)


def plain_near(docs):
    prints = [plain_fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 3 and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    first = {}
    for i, (d, _) in enumerate(docs):
        first[root[i]] = min(first.get(root[i], (True, 0, i)), (d is None, d or 0, i))
    kept = {i for *_, i in first.values()}
    return [d for i, d in enumerate(docs) if i in kept]


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_clean(docs, items):
    spans = {}
    for item in items:
        ws = plain_words(item)
        size = min(13, len(ws))
        for i in range(len(ws) - size + 1 if ws else 0):
            spans.setdefault(size, set()).add(tuple(ws[i:i + size]))
    kept = []
    for d, text in docs:
        ws, hit = plain_words(text), set()
        for size, own in spans.items():
            for i in range(len(ws) - size + 1):
                if tuple(ws[i:i + size]) in own:
                    hit |= set(range(i, i + size))
        if not (hit and 20 * len(hit) >= len(ws)):
            kept.append((d, text))
    return kept


def plain_run(docs, items):
    docs = [d for d in docs if plain_quality(d[1])]
    docs = [(d, left) for (d, _), (left, _) in zip(docs, plain_line_dedup([t for _, t in docs]), strict=True)]
    docs = plain_clean(plain_near(docs), items)
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.PIECES))
    found = []
    for d, text in docs:
        ids = [*model.encode(text or ""), model.eos_id()]
        found.append((d, len(ids), tuple(ids), hashlib.sha256(model.decode(ids).encode()).hexdigest()))
    return Counter(found)


def rows_of(df):
    return Counter((r["doc_id"], r["n_tokens"], tuple(r["ids"]), r["decoded_sha256"]) for r in df.collect())


def test_run_over_the_smallest_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want = plain_run(docs, items)
    assert 50 < len(want) < len(docs)
    assert rows_of(corpus_pipeline.run(spark, folder)) == want


def test_run_over_odd_rows(spark, tmp_path):
    words = [" ".join(f"w{chr(97 + (i * j) % 23)}{chr(97 + j % 19)}x" for j in range(30)) for i in range(1, 9)]
    lines = "This notice has been put up by the clerk of this county office again"
    texts = [*TEXTS, *words, words[0], words[1].upper(), f"{lines}\n{words[2]} and more", LONG.replace("word1 ", ""),
             *[f"{lines}\n{w} tail{i}x" for i, w in enumerate(words)], "so the passage of the benchmark " + words[3]]
    rows = [(i, t, "own", "own", len(t or ""), "f", 1, 2) for i, t in enumerate(texts)]
    rows += [(None, words[4] + " other words here", None, None, None, None, None, None), rows[3], rows[14]]
    for folder, own in (("some", rows), ("none", [])):
        path = tmp_path / folder
        spark.createDataFrame(own, SCHEMA).coalesce(1).write.parquet(str(path / "documents.parquet"))
        items = [("a", words[3]), ("b", None), (None, "?!"), ("c", "two words")]
        spark.createDataFrame(items, "item_id string, text string").write.parquet(str(path / "benchmark.parquet"))
        docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(str(path / "documents.parquet")).collect()]
        want = plain_run(docs, [t for _, t in items])
        assert rows_of(corpus_pipeline.run(spark, str(path))) == want
        assert len(want) > 5 or not own
    # Every stage but the last keeps the columns of documents.
    docs = spark.read.parquet(str(tmp_path / "some/documents.parquet"))
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, str(tmp_path / "some")).columns == docs.columns
