from harness.adapter import ADAPTER
from millstar.operators import dimensions, facts
from millstar.schemas import BRONZE_SCHEMAS, GOLD_COLUMNS, TABLE_IDS


def test_every_registered_table_is_declared_with_its_id():
    assert set(BRONZE_SCHEMAS) == set(TABLE_IDS)
    for table, idc in TABLE_IDS.items():
        assert idc in BRONZE_SCHEMAS[table].fieldNames(), table


def test_adapter_columns_match_declared_schemas():
    for table, (_, cols) in ADAPTER.items():
        assert [c for c, _ in cols] == BRONZE_SCHEMAS[table].fieldNames(), table


def test_gold_contracts_cover_builders():
    assert set(facts.FACT_BUILDERS) <= set(GOLD_COLUMNS)
    assert set(facts.FACT_REQUIREMENTS) == set(facts.FACT_BUILDERS) == set(facts.FACT_SOURCE)
    dims_built = {"dim_date", "dim_time", "dim_product", "dim_alert_type",
                  "dim_maintenance_type", *dimensions.KEYED_COPIES}
    assert len(dims_built) == 12
    needed = {d for _, ds in facts.FACT_REQUIREMENTS.values() for d in ds}
    assert needed <= dims_built
    for name, cfg in dimensions.KEYED_COPIES.items():
        assert cfg.source_key == TABLE_IDS[cfg.table], name
