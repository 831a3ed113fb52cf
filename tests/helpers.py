"""Shared by the test modules (import from here, not from conftest: there are several)."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]
