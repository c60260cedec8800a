"""Every operator and stage on nulls, empty and very long texts, ties, repeated rows, empty tables
and extra columns whose names clash with the operators' own."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from staysense.llm import (bpe_tree, byte_gru, doc_winnow, line_quality, line_runs, ngram_bloom, secret_scan, simhash_mih,
                           source_mix, url_templates)

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key long, kept boolean, host string, "
          "start long, fp long, label string, spans string, next_text string")
PROSE = " ".join(f"word{i % 37} line{i % 11}" for i in range(60))


def awkward():
    texts = [None, "", " \t\n ", "one", PROSE, PROSE, PROSE + "\n" + PROSE, "x" * 30_000, "é日 " * 9_000, "\n".join([PROSE] * 3),
             "a\u0000b " * 30, "token = 'abc123def456'", "12345 678"]
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", None, "s2"][i % 3]) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (4, "another text of the same id " * 9, "en", "s1"), (None, PROSE, "en", "s1"),
             (None, None, None, None), (99, None, "en", "s9")]
    return [(a, b, c, d, None, 7, True, "h", 3, 5, "l", "x", "n") for a, b, c, d in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


PER_ROW = {
    "quality": lambda d: line_quality.judge(d),
    "mix": lambda d: source_mix.taken(d),
    "secrets": lambda d: secret_scan.digest(secret_scan.scan(d)),
    "bloom": lambda d: ngram_bloom.score(d),
    "simhash": lambda d: simhash_mih.group(d),
    "language": lambda d: byte_gru.identify(d, plan=byte_gru.GruPlan(epochs=2)),
    "line_dedup": lambda d: line_runs.drop_repeats(d, removed_col="removed"),
    "bpe": lambda d: bpe_tree.encode_decode(d, bpe_tree.read_spec()),
    "winnow": lambda d: doc_winnow.digest(doc_winnow.compare_edited(d)),
    "urls": lambda d: url_templates.judge(d.withColumn("url", F.col("text")), [("block", "com/")], id_col="doc_id"),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_row(docs, name):
    rows = PER_ROW[name](docs).collect()
    assert len(rows) == docs.count()


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(empty, name):
    assert PER_ROW[name](empty).collect() == []


@pytest.mark.parametrize("name", ["secrets", "simhash", "bpe", "bloom", "language", "quality", "winnow"])
def test_repeated_rows_agree(docs, name):
    def value(r):
        return tuple((k, str(v)) for k, v in sorted(r.asDict().items()) if k not in (
            "edited_sha256", "edited_fingerprint", "near_edited", "near_next"))
    rows = [value(r) for r in PER_ROW[name](docs.where("doc_id = 4")).collect()]
    assert len(rows) == 4 and max(rows.count(r) for r in rows) >= 3     # three equal rows and one other


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_keep_columns(spark, docs, empty, name, stage):
    out = stage(spark, docs, "/nowhere")
    rows = out.collect()
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == docs.columns
        assert dict(out.dtypes) == dict(docs.dtypes)
    assert len(rows) <= 2 * docs.count()
    assert stage(spark, empty, "/nowhere").count() == 0


def test_null_text_results(docs):
    one = docs.where("doc_id = 0")
    q = line_quality.judge(one).first()
    assert (q.n_words, q.word_chars, q.n_repeat_words, q.base_failed, q.kept) == (0, 0, 0, True, False)
    assert byte_gru.identify(docs).where("doc_id = 0").first().lang_pred == "und"
    assert simhash_mih.group(one).first().fp == 0
    assert bpe_tree.encode_decode(one, bpe_tree.read_spec()).first().n_tokens == 0
