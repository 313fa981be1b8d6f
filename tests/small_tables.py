"""What the tests share besides fixtures; a module of its own, as every folder may have a conftest."""

SMALL = "/root/testdata/sf0.001"


def rows(df, *columns):
    """Rows as a sorted list of tuples, NULL first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, v) for v in r])
