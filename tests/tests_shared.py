import datetime as dt


def day(x):
    return dt.date.fromisoformat(x) if x else None


def membership(spark, rows):
    """(symbol, security, sector, industry, from, to, known) as the stored table, with null columns that no operator reads."""
    schema = "symbol string, security string, gics_sector string, gics_sub_industry string, valid_from date, valid_to date, gics_revision_timestamp string, cik string"
    return spark.createDataFrame([(s, n, a, b, day(f), day(t), k, "1") for s, n, a, b, f, t, k in rows], schema)


def snapshots(spark, rows):
    """(symbol, security, sector, industry, date, captured)"""
    schema = "symbol string, security string, gics_sector string, gics_sub_industry string, snapshot_date date, captured_at timestamp, hq_location string"
    return spark.createDataFrame([(s, n, a, b, day(d), dt.datetime.fromisoformat(c) if c else None, "x") for s, n, a, b, d, c in rows], schema)
