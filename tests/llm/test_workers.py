"""The operators on workers that have no copy of the package on their path."""
import os
import subprocess
import sys
from pathlib import Path

from trajlake.llm import packing

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from trajlake.llm import exact_dedup, fingerprints, language, minhash, mixing, packing, quality, repeats, toxicity
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
words = ["red", "green", "blue", "stone", "river", "cloud"]
rows = [(i, " ".join(words[(i + j * j) % 6] for j in range(60)) + f" {i % 3}", "en" if i % 2 else "fr", "a", i % 2) for i in range(12)]
docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, mark int")
labels = docs.selectExpr("doc_id", "mark as toxic", "mark as quality")
assert repeats.remove_repeats(docs).count() == 12
assert fingerprints.fingerprint_documents(docs).count() == 12
assert minhash.near_duplicates(docs).count() == 12
assert language.predict_languages(docs, language.fit_languages(docs)).count() == 12
assert toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels)).count() == 12
assert quality.score_quality(docs, quality.fit_quality(docs, labels)).count() == 12
assert mixing.mix_documents(docs).count() > 0
if sys.argv[2] == "pack":
    assert packing.pack_documents(docs).count() == 12
print("done")
"""


def test_task_functions_travel_with_the_job(tmp_path):
    try:
        vocabulary = os.path.exists(packing.tokenizer_path())
    except ImportError:
        vocabulary = False
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", SCRIPT, str(Path(__file__).resolve().parents[2]), "pack" if vocabulary else "no"],
                         cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert got.returncode == 0 and "done" in got.stdout, got.stderr[-3000:]
