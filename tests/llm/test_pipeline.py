"""The whole pipeline against plain versions of its stages, on the smallest tables and on awkward rows."""

from __future__ import annotations

import re
import zlib

import brute
import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline as pipeline  # noqa: E402
from marquee.llm import quality  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def passes_rules(text: str | None, size: int = 8) -> bool:
    """The table of thresholds, read row by row."""
    text = text or ""
    words = brute.WORD.findall(text)
    lines = [line for line in text.split("\n") if brute.WORD.search(line)]
    windows = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
    seen = {w: windows.count(w) for w in set(windows)} if len(set(windows)) < len(windows) else {}
    repeated = {j for i, w in enumerate(windows) if seen.get(w, 1) > 1 for j in range(i, i + size)}
    if len(words) < 20 or 100 * len(repeated) > 30 * len(words):
        return False
    measured = {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_exclamations": text.count("!"),
        "n_stop_words": sum(w.lower() in quality.STOP_WORDS for w in words),
    }
    for rule in quality.RULES:
        if measured["n_words"] >= rule.from_words and measured[rule.whole]:
            if not rule.low <= measured[rule.part] / measured[rule.whole] <= rule.high:
                return False
    return True


def kept_texts(docs: list[tuple[int, str | None]], items: list[tuple[object, str | None]]) -> dict[int, str]:
    """The documents that reach the last stage, with the text they have there."""
    docs = [(d, t) for d, t in docs if passes_rules(t)]
    docs = [(d, t) for (d, t), (_, _, group) in zip(docs, brute.components(docs)) if d == group]
    docs = [(d, cut if removed else t) for (d, t), (_, _, removed, cut) in zip(docs, brute.repeats(docs))]
    return {d: t for (d, t), found in zip(docs, brute.contamination(docs, items)) if not found[-1]}


def check(spark, folder: str) -> set[int]:
    from tokenizers import Tokenizer

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    expected = kept_texts(docs, items)
    tokenizer = Tokenizer.from_file(pipeline.tokenizer())
    ids = {d: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4") for d, t in expected.items()}
    pieces, sequences = {}, {}
    for p in pipeline.run(spark, folder).collect():
        mine = ids[p["doc_id"]]
        assert p["doc_tokens"] == len(mine)
        assert p["ids_crc32"] == zlib.crc32(mine[p["start"] : p["start"] + p["length"]].tobytes())
        pieces.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts, total in [(pieces[d], len(mine)) for d, mine in ids.items()] + [(s, None) for s in sequences.values()]:
        ends = [0]
        for begin, length in sorted(parts):
            assert begin == ends[-1] and length > 0
            ends.append(begin + length)
        assert ends[-1] <= 1024 if total is None else ends[-1] == total
    return set(expected)


def test_smallest_tables(spark):
    assert len(check(spark, SMALL)) > 20


def test_awkward_rows(spark, tmp_path):
    from test_operators import prose, texts

    plain = texts() + [f"the {prose(90 + s, 80, 10**6)} and of to in is it" for s in range(6)]
    plain.append(f"{plain[-1]} {prose(200, 60, 10**6)} and the of")
    rows = [(i, t, None, None, len(t) if t else None, "k") for i, t in enumerate(plain)]
    names = "doc_id long, text string, lang string, source string, n_chars long, key string"
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/documents.parquet")
    items = [("a", " ".join(plain[-3].split()[3:40])), ("b", None), ("c", "")]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = check(spark, str(tmp_path))
    assert len(plain) - 3 not in kept and len(plain) - 4 in kept


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).schema.names == docs.columns


def test_no_documents(spark, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
