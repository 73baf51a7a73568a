"""The registered queries do without the corpus operators."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(block):
    code = f"""
import sys
for name in {block!r}:
    sys.modules[name] = None
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()))
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    return done.returncode, done.stdout.split(), done.stderr


def test_without_the_corpus_operators():
    code, counts, error = names(["corpus_pipeline", "talkgauge.llm"])
    assert code == 0, error
    assert counts[0] == counts[1] and int(counts[0]) >= 108


def test_without_a_library_of_theirs():
    code, counts, error = names(["zstandard"])
    assert code == 0 and counts[0] == counts[1] and "zstandard" in error


def test_other_import_errors_are_not_swallowed():
    code, _, error = names(["talkgauge.plans.oracle"])
    assert code != 0 and "talkgauge.plans.oracle" in error
