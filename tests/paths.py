"""Test tables: TPC-H-ish Parquet folders at two scale factors."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
