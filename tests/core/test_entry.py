import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]


def test_queries_and_oracles_have_names_in_common():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 50


def test_entry_without_the_corpus_operators(tmp_path):
    """The entry module imports, and keeps the core queries, where the corpus operators have been removed."""
    for name in ("__spark_entry__.py", "siltstone"):
        subprocess.run(["cp", "-r", str(ROOT / name), str(tmp_path)], check=True)
    subprocess.run(["rm", "-rf", str(tmp_path / "siltstone/llm")], check=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'recurrence' in q and not any(n.startswith('op') and n[2].isdigit() for n in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
