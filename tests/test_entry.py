import re
from pathlib import Path

import __spark_entry__
from tests.conftest import ROOT, SF


def test_entry_and_registry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    names, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(names) and len([n for n in names if n.startswith("cdc_")]) >= 21
    df = names["cdc_lsn_order"](spark, SF)
    assert df.columns == ["event_id", "n", "lsn"]


def test_nothing_outside_the_corpus_package_needs_it():
    for p in Path(ROOT, "walrill").rglob("*.py"):
        if "llm" not in p.parts:
            assert not re.search(r"walrill\.llm|corpus_pipeline", p.read_text()), p
