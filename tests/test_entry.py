import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def without(*modules):
    """The names of all queries when ``modules`` cannot be imported."""
    code = f"import sys; sys.modules.update({{m: None for m in {modules!r}}}); import __spark_entry__ as e; print(*e.queries()); e.oracle_sql()"
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)


def test_all_but_the_corpus_queries_are_there_without_them():
    for modules in (("corpus_pipeline",), ("statelake.llm",), ("corpus_pipeline", "statelake.llm")):
        names = without(*modules).stdout.split()
        assert "medallion_daily" in names and not [n for n in names if n.startswith("op") or n == "pipeline"]
