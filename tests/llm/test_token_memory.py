"""Token counts: one counter a process, bounded memories, empty tables."""

import os
import subprocess
import sys

import public_tokenizers

from cairn.llm import token_counts

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(token_counts.__file__))))
PATH = public_tokenizers.path("word_bpe_49k.json")


def test_memory_stays_flat_over_thirty_tasks():
    """Resident memory of a process that works through thirty tasks of ever new words."""
    code = f"""
import sys, resource
sys.path.insert(0, {ROOT!r})
from cairn.llm.token_counts import process_counter
def rss():
    return int(open("/proc/self/statm").read().split()[1]) * resource.getpagesize() >> 20
seen = []
for task in range(30):
    count = process_counter({PATH!r})
    count([b" ".join(b"w%dx%d" % (task, i) for i in range(40000))])
    seen.append(rss())
print(seen[9], seen[29])
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    early, late = map(int, out.stdout.split()[-2:])
    assert late - early < 60, (early, late)


def test_forgetting_changes_no_count(monkeypatch):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(PATH)
    monkeypatch.setattr(token_counts, "MEMO_TOTAL", 500)
    count = token_counts.piece_counter(PATH)
    texts = [f"some w{i} words again, don't {i * 7919} <|x|> ÄÖ {'y' * (i % 60)}" for i in range(200)] * 2
    assert count([t.encode() for t in texts]) == [len(tok.encode(t, add_special_tokens=False)) for t in texts]


def test_empty_table(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string").filter("false")
    assert token_counts.count_tokens(df, PATH).count() == 0
