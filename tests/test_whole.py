"""Queries take all rows of their tables."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

from foliant.plans.catalogue_queries import ORACLE_SQL, QUERIES

from .test_oracle import SF, rows


def test_citation_fold_takes_every_supplier(spark, tmp_path):
    supplier = pq.read_table(f"{SF}/supplier.parquet").slice(0, 5)
    at = supplier.schema.get_field_index("s_suppkey")
    supplier = supplier.set_column(at, supplier.schema.field(at), pa.array([7, 9999, 10000, 123456, 2000000000], supplier.schema.field(at).type))
    pq.write_table(supplier, f"{tmp_path}/supplier.parquet")
    found = QUERIES["citation_fold"](spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW supplier AS SELECT * FROM '{tmp_path}/supplier.parquet'")
    assert rows(found) == rows(con.execute(ORACLE_SQL["citation_fold"]).df())


def test_block_paragraphs_takes_every_line_item(spark):
    found = QUERIES["block_paragraphs"](spark, SF).toPandas()
    assert sum(t.count("block ") for t in found["text"]) == pq.read_metadata(f"{SF}/lineitem.parquet").num_rows
