import random
import re
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry
from pyspark.sql import functions as F

from voxloom.functions import text

ROOT = Path(entry.__file__).parent


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["lang", "n_docs", "n_chars", "n_sources"]


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_rest_imports_without_the_subpackage():
    code = "import sys; sys.modules['voxloom.' + 'l' + 'lm'] = None; import __spark_entry__ as e; assert 'flagship' in e.queries() and 'p3_found' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_normalize_against_plain_python(spark):
    r = random.Random(8)
    given = ["".join(r.choice("aÄßé9_ .,;!?\t\n -'’€[]ɛɔñ") for _ in range(r.randrange(0, 30))) for _ in range(500)]
    got = [x.n for x in spark.createDataFrame(list(enumerate(given)), "i int, t string").orderBy("i").select(text.normalize_text(F.col("t")).alias("n")).collect()]
    assert got == [re.sub(r"\s+", " ", re.sub(r"[^\w\s]", "", t.lower())).strip() for t in given]
