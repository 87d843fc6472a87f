"""Every registered query against its SQL, or for a result at all where there is none."""

import pytest

from hostscope.plans import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, compare):
    if name in SQL:
        compare(QUERIES[name], SQL[name])
    else:
        assert QUERIES[name](spark, sf).count() > 0


def test_entry_imports_without_the_corpus_part():
    import subprocess
    import sys
    import textwrap
    from pathlib import Path

    code = """
        import sys, importlib.util
        real = importlib.util.find_spec
        importlib.util.find_spec = lambda n, *a: None if n.startswith("hostscope.llm") else real(n, *a)
        import __spark_entry__ as e
        assert not [n for n in e.queries() if n.startswith("op")] and len(e.oracle_sql()) > 90
        assert not [m for m in sys.modules if m.startswith("hostscope.llm")]
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], check=True, cwd=Path(__file__).resolve().parents[1])
