"""One text of 20 MB: time and memory of what runs in a task over it."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
MB = 20

SCRIPT = """
import json, random, resource, sys, time
import numpy as np, pyarrow as pa
sys.path.insert(0, sys.argv[1])
what = sys.argv[2]
rnd = random.Random(1)
vocab = ["".join(rnd.choice("abcdefghiklmnoprstuvé") for _ in range(rnd.randint(1, 11))) for _ in range(200_000)]
text, size = [], 0
while size < int(sys.argv[3]) << 20:
    text.append(rnd.choice(vocab)); size += len(text[-1].encode()) + 1
column = pa.array([" ".join(text)], pa.large_string())
del text, vocab
from lodestar.llm import decontaminate, fingerprints, jaccard_join, language, toxicity
from lodestar.llm.words import Words
rng = np.random.default_rng(1)
def run():
    if what == "words": Words(column).text_keys()
    if what == "op2": decontaminate.winnow(Words(column))
    if what == "op3": fingerprints.sketch(column)
    if what == "op4": language.predict(column, model)
    if what == "op8": jaccard_join.minhashes(Words(column))
    if what == "op9": toxicity.score_texts(column, (line, 0.0))
model = language.Model(["aa", "bb", "cc", "dd"], np.log(rng.dirichlet(np.ones(1 << 15), 4).T + 1e-9) / 4)
line = rng.normal(size=toxicity.BUCKETS)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
began = time.process_time()
run()
print(json.dumps({"s": time.process_time() - began, "mb": (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024}))
"""


@pytest.mark.parametrize("what, bytes_per_byte", [("words", 16), ("op2", 20), ("op3", 30), ("op4", 40), ("op8", 30), ("op9", 30)])
def test_a_text_of_20_mb(what, bytes_per_byte):
    out = subprocess.run([sys.executable, "-c", SCRIPT, ROOT, what, str(MB)], capture_output=True, text=True, timeout=600, check=True)
    used = json.loads(out.stdout.splitlines()[-1])
    assert used["s"] < 90 and used["mb"] < bytes_per_byte * MB, used
