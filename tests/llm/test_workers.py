"""The operators with Python code send executors all that they need."""

from tests.test_workers import run_elsewhere

SCORE = """
from quernel.llm import lm_score
docs = spark.createDataFrame([(i, f"a b a b c {i % 3}") for i in range(20)], "doc_id long, text string").repartition(2)
assert lm_score.query(docs).count() == 20
"""


def test_language_models_reach_executors_without_the_package(tmp_path):
    run_elsewhere(SCORE, tmp_path)
