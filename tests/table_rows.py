"""Rows of a DataFrame in a fixed order, for comparisons."""


def rows(df, *columns):
    """Sorted tuples of the chosen columns."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
