"""Executors have no copy of the package: only what a job sends them."""

import subprocess
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parents[1])

HEAD = f"""
import sys
sys.path.insert(0, {ROOT!r})
from quernel.session import build_session
spark = build_session("elsewhere", 2, partitions=2)
"""

ENCODE = """
from quernel.operators.tokens import Tokenizer, decoder, encoder
t = Tokenizer.train(["abab abab"], 300)
rows = spark.createDataFrame([("abab",), (None,), ("",)], "text string").repartition(2)
back = rows.select("text", decoder(spark, t)(encoder(spark, t)("text")).alias("back")).collect()
assert sorted(map(str, (r.back for r in back))) == sorted(map(str, (r.text for r in back))), back
"""


def run_elsewhere(code: str, folder: Path) -> None:
    """Run code in a process whose workers can't import the package from their folder."""
    done = subprocess.run([sys.executable, "-c", HEAD + code], cwd=folder, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]


def test_tokenizers_reach_executors_without_the_package(tmp_path):
    run_elsewhere(ENCODE, tmp_path)
