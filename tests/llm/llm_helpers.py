"""Row comparison for these tests."""


def by_row(df, *columns):
    """Sorted (doc_id, columns...) tuples; NULL ids first."""
    got = [tuple(r) for r in df.select("doc_id", *columns).collect()]
    return sorted(got, key=lambda r: tuple((x is not None, str(type(x)), x) for x in r))


def ordered(tuples):
    return sorted(tuples, key=lambda r: tuple((x is not None, str(type(x)), x) for x in r))
