"""Columns derived from the tables, as SQL that Spark and DuckDB read alike."""

from __future__ import annotations


def wide_columns(n: int = 100) -> dict[str, str]:
    """``n`` numeric columns derived from the line items, as SQL that Spark and DuckDB share; every
    tenth is NULL in a seventh of the rows, other rows for each."""
    out = {}
    for k in range(n):
        value = (f"(l_orderkey * {k % 7 + 1} + l_partkey * {k % 11 + 2} + l_suppkey * {k % 5}) "
                 f"% {17 + k} + {k % 4} * CAST(l_quantity AS INT)")
        out[f"c{k}"] = (f"CASE WHEN (l_linenumber + {k}) % 7 <> 0 THEN {value} END"
                        if k % 10 == 9 else value)
    return out


def csv_line() -> str:
    """A customer as a CSV line: by the key some lack a field, have one more, open a quote that
    they do not close, or hold a separator in quotes."""
    return ("CASE WHEN c_custkey % 11 = 3 THEN concat(CAST(c_custkey AS STRING), ',', c_name) "
            "WHEN c_custkey % 11 = 5 THEN concat(CAST(c_custkey AS STRING), ',', c_name, ',', "
            "c_mktsegment, ',', 'x') "
            "WHEN c_custkey % 11 = 7 THEN concat(CAST(c_custkey AS STRING), ',\"', c_name, ',', "
            "c_mktsegment) "
            "WHEN c_custkey % 11 = 9 THEN concat(CAST(c_custkey AS STRING), ',\"', c_name, "
            "', Inc.\",', c_mktsegment) "
            "ELSE concat(CAST(c_custkey AS STRING), ',', c_name, ',', c_mktsegment) END")
