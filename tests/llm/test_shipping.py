"""Executors need not have the package: a session started elsewhere, with the path set on the driver only."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from tessera.session import get_session
import __spark_entry__ as entry
spark = get_session("local[2]", 2)
for name in ("op1_ann_graph", "op2_sentencepiece", "op3_decontamination", "op4_language_id", "op6_html_text", "op7_simhash", "op8_warc", "op9_chat_format", "op10_quality"):
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("shipped")
"""


def test_queries_run_without_the_package_on_executors(tmp_path):
    repo = str(Path(__file__).resolve().parents[2])
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and not k.startswith(("SPARK_", "PYSPARK_"))}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "shipped" in done.stdout, done.stderr[-2000:]
