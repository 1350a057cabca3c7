"""Dialog splits (S10, A10), XML dump scan (S5), tokenize job (T7), quality recipe (M7)."""

import os
import tempfile

from pyspark.sql import functions as F


def test_dialog_splits_and_counts(spark):
    from quarry.operators.dialog import dialog_split_counts
    from quarry.sources.corpus import read_dialog_splits
    base = tempfile.mkdtemp(prefix="quarry-dd-")
    os.makedirs(f"{base}/train")
    with open(f"{base}/train/dialogues_train.txt", "w") as f:
        f.write("Hi __eou__ Hello __eou__\n\n only one __eou__\nA __eou__  __eou__ B __eou__ C __eou__\n")
    lines = read_dialog_splits(spark, ["/nonexistent/x", base])
    got = {r["split"]: r["n_dialogs"] for r in dialog_split_counts(lines).collect()}
    assert got == {"train": 2}   # blank line and single utterance drop; validation/test missing
    from quarry.operators.dialog import dialog_from_line
    t = spark.createDataFrame([("A __eou__  __eou__ B __eou__ C __eou__",)], "l string") \
             .select(dialog_from_line(F.col("l")).alias("t")).first()["t"]
    assert t == "<|user|>\nA\n<|assistant|>\nB\n<|user|>\nC\n<|endoftext|>\n"


def test_wiki_xml_scan(spark):
    from quarry.sources.corpus import read_wiki_xml
    d = tempfile.mkdtemp(prefix="quarry-xml-")
    with open(f"{d}/dump.xml", "w") as f:
        f.write("<mediawiki><page><title>Alpha</title><revision><text>Body '''one'''</text></revision></page>"
                "<page><title>Talk:Alpha</title><revision><text>talk</text></revision></page></mediawiki>")
    rows = {r["title"]: r["text"] for r in read_wiki_xml(spark, f"{d}/dump.xml").collect()}
    assert rows == {"Alpha": "Body '''one'''", "Talk:Alpha": "talk"}


def test_tokenize_job_caches(spark):
    from quarry.plans.jobs import tokenize_job
    docs = spark.createDataFrame([(1, "the cat sat on the mat"), (2, "the hat")], "doc_id long, text string")
    out = tempfile.mkdtemp(prefix="quarry-tj-")
    t1 = {r["doc_id"]: r["ids"] for r in tokenize_job(spark, docs, out, vocab_size=256 + 3 + 5).collect()}
    t2 = {r["doc_id"]: r["ids"] for r in tokenize_job(spark, docs, out, vocab_size=256 + 3 + 50).collect()}
    assert t1 == t2 and len(t1) == 2    # second run reuses the saved tokenizer and tokens


def test_quality_recipe(spark):
    from quarry.plans.jobs import quality_recipe
    from quarry.sources import tables
    from tests.conftest import SF001
    docs = tables.documents(spark, SF001).select("doc_id", "text")
    lab = tables.labels(spark, SF001)
    pos = docs.join(lab.filter(F.col("quality") == 1), "doc_id", "left_semi")
    neg = docs.join(lab.filter(F.col("quality") == 0), "doc_id", "left_semi")
    _, m = quality_recipe(pos, neg)
    r = m.first()
    assert r["n"] > 0 and 0.0 <= r["precision_at_1"] <= 1.0


def test_queries_run_from_another_folder():
    """Workers of a session we did not make, in a folder that does not hold the package, can import it."""
    import os
    import subprocess
    import sys
    import tempfile
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import importlib.util, sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spec = importlib.util.spec_from_file_location("entry", {root!r} + "/__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
print("rows", entry.queries()["bpe_encode_bytes"](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tempfile.mkdtemp(), env=env, capture_output=True, text=True, timeout=300)
    assert "rows 200" in out.stdout, out.stderr[-2000:]
