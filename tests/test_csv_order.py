"""A dictionary table that goes on in the next CSV file has its first line in the file before."""

from __future__ import annotations

from checks.compare import differences


def test_files_are_read_in_the_order_of_their_numbers(spark, tmp_path):
    def table(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).toPandas().to_parquet(f"{tmp_path}/{name}.parquet")

    # Table 499 has fields in files 9 and 10.
    table("region", [(0, "R")], "r_regionkey bigint, r_name string")
    table("nation", [(0, "N", 0)], "n_nationkey bigint, n_name string, n_regionkey bigint")
    table("supplier", [(499, "S", 0)], "s_suppkey bigint, s_name string, s_nationkey bigint")
    parts = [(key, f"name {key}", "TYPE", "Brand", 1) for key in (11, 25, 1_000_010, 1_000_020)]
    table("part", parts, "p_partkey bigint, p_name string, p_type string, p_brand string, p_size bigint")
    table("lineitem", [(499, row[0]) for row in parts], "l_suppkey bigint, l_partkey bigint")
    assert differences("source_from_csv_files", spark, str(tmp_path)) == []
