"""The pipeline against a plain version of all its stages."""

import random
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from panelcast.llm.line_dedup import BLANKS
from tests.llm import plain


def without_lines(rows):
    """(id, text) after the first of each group of lines alone stays; documents left without a line go, unless they had none."""
    groups, out = plain.line_groups(rows), []
    for doc, text in rows:
        lines = text.split("\n")
        own = [(doc, n) for n, line in enumerate(lines) if line.strip(BLANKS)]
        kept = "\n".join(line for n, line in enumerate(lines) if not line.strip(BLANKS) or groups[doc, n] == (doc, n))
        if not own or kept.strip(BLANKS + "\n"):
            out.append((doc, kept))
    return out


def expected(rows):
    """Tokens of every document that stays; a text stays in the first stage if it has a letter (all languages here are learned)."""
    left = without_lines(sorted((d, t) for d, t in rows if t and any(c.isalpha() for c in t)))
    groups = plain.simhash_groups(left)
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {d: [*tokens.encode(t, add_special_tokens=False).ids, 1] for d, t in left if groups[d] == d}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """The test table, reflowed near copies of some of its texts, and texts that the first stage rejects."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    draw, rows = random.Random(3), [(2 * 10**6, None, "en", "s", None), (2 * 10**6 + 1, "", "en", "s", 0), (2 * 10**6 + 2, "12 34\n!", "en", "s", 7)]
    for row in [r for r in docs.orderBy("doc_id").collect() if r["text"] and 150 < len(r["text"].split()) < 400][:12]:
        for width in (13, 17, 23):
            words = row["text"].split()
            words[draw.randrange(len(words))] = "zzz"
            text = "\n".join(" ".join(words[i: i + width]) for i in range(0, len(words), width))
            rows.append((10**6 + len(rows), text, row["lang"], row["source"], len(text)))
    folder = tmp_path_factory.mktemp("corpus")
    docs.unionByName(spark.createDataFrame(rows, docs.schema)).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_run_against_plain_version(spark, corpus):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{corpus}/documents.parquet").collect()]
    want = expected(rows)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.run(spark, corpus).collect():
        ids = [int.from_bytes(r["ids"][i: i + 4], "little") for i in range(0, len(r["ids"]), 4)]
        assert len(ids) == r["length"]
        pieces[r["doc_id"]].append((r["start"], ids))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    got = {d: [i for _, ids in sorted(found) for i in ids] for d, found in pieces.items()}
    assert len(want) < len(rows) - 12 and got == want
    for found in sequences.values():
        found.sort()
        assert [o for o, _ in found] == [sum(n for _, n in found[:i]) for i in range(len(found))] and sum(n for _, n in found) <= 2048


def test_stages_keep_columns(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, corpus).columns == docs.columns, name
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash", "packing"] and corpus_pipeline.ORACLE_SQL is None


def test_empty_and_odd_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    base = [(i, f"the first line of text number {'abcdefghij'[i % 10] * (i + 3)} is here\nand another {'klmnopqrst'[i % 10] * (i + 5)} one", "en", "s", 1) for i in range(40)]
    odd = [(1, "a text of its own under an id that comes twice", "en", None, 1), base[3], (None, None, None, None, None), (None, "an english sentence without any id at all", "en", "s", 1), (90, "", "en", "s", 0)]
    spark.createDataFrame(base + odd, schema).write.parquet(f"{tmp_path}/odd/documents.parquet")
    got = {(r["doc_id"]) for r in corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()}
    assert {None, 1, 3} <= got and 90 not in got
