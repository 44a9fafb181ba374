"""Python operators run where only the driver can import the package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from lanegraph.session import local_session
spark = local_session(2, 2)
def seen(batches):
    import importlib.util, pyarrow as pa
    for b in batches:
        yield pa.RecordBatch.from_pydict({{"n": [int(importlib.util.find_spec("lanegraph") is not None)]}})
seen.__module__ = "__main__"
assert spark.range(1).mapInArrow(seen, "n long").first().n == 0, "the workers see the package"
docs = spark.createDataFrame([(i, "der die das und ein kleines haus" if i % 2 else "the quick brown fox jumps over it", "de" if i % 2 else "en", "s", 30)
                              for i in range(40)], "doc_id long, text string, lang string, source string, n_chars long")
from lanegraph.llm import langid, lbl, suffix_dedup, spelling, decontaminate, packing, minhash, registry, conversation_repair
from lanegraph.operators import boost
assert langid.identify(docs).where("lang_pred in ('de', 'en')").count() == 40
assert langid.keep_identified(docs, langid.train(docs)).count() == 40
assert lbl.score(docs, rounds=1, steps=2).where("score < 0").count() == 40
assert suffix_dedup.remove_repeats(docs).count() == 40
assert spelling.spelling_variants(docs).count() > 0
assert decontaminate.contamination(docs, docs.withColumnRenamed("doc_id", "item_id")).where("contaminated").count() == 40
assert packing.pack_documents(docs, registry.word_bpe()).count() == 40
assert minhash.near_classes(docs).count() == 40
talk = docs.selectExpr("doc_id as conv_id", "0L as turn", "'user' as role", "text")
assert conversation_repair.reports(conversation_repair.as_rows(talk)).count() == 40
model = boost.fit(docs, ["n_chars"], "doc_id", "doc_id", boost.Setting(rounds=2, depth=2))
assert boost.predict(model, docs, ["doc_id"]).count() == 40
print("all ran")
"""


def test_workers_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all ran" in run.stdout, run.stderr[-3000:]
