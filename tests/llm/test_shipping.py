from __future__ import annotations

import os
import pathlib
import subprocess
import sys

ROOT = str(pathlib.Path(__file__).parents[2])
CODE = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
from llm import op3_bpe, op4_ngram_jaccard, op5_quality_rules, op6_token_output, op7_language_id, op8_suffix_dedup, op9_substring_dedup, op10_warc
docs = spark.createDataFrame([(1, "a b c", "en", "s", "u", "h")], "doc_id long, text string, lang string, source string, url string, html string").selectExpr("*", "doc_id AS page_id")
for f in (op3_bpe.bpe, op4_ngram_jaccard.jaccard_join, op5_quality_rules.measured, op6_token_output.write_tokens, op7_language_id.language_id, op8_suffix_dedup.suffix_dedup, op9_substring_dedup.substring_dedup, op10_warc.write_warc):

    out = f(docs)
    assert (out[1] if isinstance(out, tuple) else out).count() == 1, f
"""

def test_operators_reach_workers_from_any_folder(tmp_path):
    """The driver alone can see the package; each operator sends it to the workers itself."""
    env = dict(os.environ) | {"PYTHONPATH": os.environ.get("PYTHONPATH", "").replace(ROOT, ""), "SPARK_LOCAL_DIRS": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-3000:]
