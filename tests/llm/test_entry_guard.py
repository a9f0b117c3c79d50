import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).parents[2]


def test_core_works_without_the_subpackage(tmp_path):
    """A copy without the llm folders and the pipeline still imports and registers the other queries."""
    for name in ("loretable", "__spark_entry__.py"):
        (tmp_path / name).symlink_to(REPO / name) if name.endswith(".py") else (tmp_path / name).mkdir()
    for p in (REPO / "loretable").iterdir():
        if p.name not in ("llm", "__pycache__"):
            (tmp_path / "loretable" / p.name).symlink_to(p)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and not any(k.startswith('op') for k in q) and 'pipeline' not in q; e.oracle_sql()"
    done = subprocess.run([sys.executable, "-c", f"import sys; sys.path.insert(0, {str(tmp_path)!r}); {code}"], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_nothing_outside_imports_the_subpackage():
    for p in (REPO / "loretable").rglob("*.py"):
        if "llm" not in p.relative_to(REPO / "loretable").parts:
            assert "loretable.llm" not in p.read_text(encoding="utf-8"), p
