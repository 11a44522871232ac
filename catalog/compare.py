"""Compare a query's rows with those of its SQL."""

from __future__ import annotations

import glob
import os

import duckdb


def open_tables(sf_dir: str):
    """DuckDB connection with one view per Parquet table."""
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return db


def canonical(columns, values):
    """Column names in order, and rows as sorted text with floats rounded."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def show(value):
        if isinstance(value, float):
            return f"{value:.9g}"
        return value.isoformat() if hasattr(value, "isoformat") else str(value)

    return [columns[i] for i in order], sorted(tuple(show(row[i]) for i in order) for row in values)


def both_sides(frame, db, sql):
    expected = db.execute(sql)
    names = [d[0] for d in expected.description]
    return canonical(frame.columns, frame.collect()), canonical(names, expected.fetchall())
