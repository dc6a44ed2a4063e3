import subprocess
import sys
from collections import Counter
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_test_modules_have_names_of_their_own():
    names = Counter(p.name for p in (ROOT / "tests").rglob("test_*.py"))
    assert [name for name, n in names.items() if n > 1] == []


def test_queries_load_without_the_subpackage_or_its_libraries():
    for missing in ("sparkprep.llm", "public_tokenizers", "corpus_pipeline"):
        code = (
            "import sys\n"
            f"sys.modules[{missing!r}] = None\n"
            "import __spark_entry__ as e\n"
            "assert len(e.queries()) > 100 and not [n for n in e.queries() if n.startswith('op')]"
        )
        subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT)


def test_nothing_else_imports_the_subpackage():
    files = [p for p in (ROOT / "sparkprep").rglob("*.py") if "llm" not in p.parts]
    assert [str(p) for p in files if "sparkprep.llm" in p.read_text()] == []
