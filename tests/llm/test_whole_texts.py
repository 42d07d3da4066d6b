"""Operators on training text do the whole job: against brute force on small tables."""

import zlib

import numpy as np

import corpus_pipeline
from tidemark.llm import language, secret_scan
from tidemark.llm.common import table

SF = "/root/testdata/sf0.01"


def test_language_thresholds_cover_all_training_rows(spark):
    docs = table(spark, SF, "documents")
    model = language.fit(docs, sample_rows=64)
    cosines = {}
    for row in language.training_rows(docs).collect():
        if (counts := language.gram_counts(row.text)) is not None:
            cosines.setdefault(int(np.log2(counts.sum())), []).append(float(model.nearest(counts[None])[1][0]))
    enough = [size for size, found in cosines.items() if len(found) >= 20]
    assert len(enough) >= 4
    for size in enough:
        exact = 0.5 * float(np.quantile(cosines[size], 0.01, method="lower"))
        assert exact - 1 / 4096 < model.thresholds[size] <= exact + 1e-6


def test_secret_values_after_any_key_are_candidates(spark):
    long_value = "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY12"
    texts = [
        ("password=hunter2x9", "hunter2x9"),
        ("é DB1_PASSWORD=hunter2x9 rest", "hunter2x9"),
        ("OAUTH2_TOKEN=abcDEF12345", "abcDEF12345"),
        ("password" + " " * 30 + "=" + "\t" * 9 + "hunter2x9", "hunter2x9"),
        (f"S3_SECRET_KEY={long_value}", long_value),
        (f"S3_SECRET_KEY{' ' * 40}={' ' * 40}{long_value}", long_value),
        ("DB1_PASSWORD=hunter2x9\nDB2_PASSWORD='hunter3x9'\n" * 90, "hunter2x9"),
    ]
    docs = spark.createDataFrame([(k, text) for k, (text, _) in enumerate(texts)], "doc_id bigint, text string")
    found = secret_scan.with_features(secret_scan.candidates(docs)).collect()
    for row in found:
        assert texts[row.doc_id][0][row.start : row.stop] == row.value
    for k, (text, value) in enumerate(texts):
        mine = [row for row in found if row.doc_id == k and row.value == value]
        assert len(mine) == text.count(value)
        assert all(row.cue and row.assigned for row in mine)
    assert sum(row.value == "hunter3x9" for row in found) == 90


def test_pipeline_hands_out_token_ids(spark, edge_docs):
    rows = corpus_pipeline.sequences(spark, edge_docs, SF).collect()
    assert rows
    assert all(len(row.ids) == 4 * row.length and zlib.crc32(row.ids) == row.ids_crc32 for row in rows)
