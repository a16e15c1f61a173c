"""Long cells by brute force over Python's csv module, for small fixtures."""

import csv


def parse(path, threshold, encoding="utf-8", **csv_opts):
    """(row_index, column_index, name, value) of each cell, or None without a header."""
    with open(path, encoding=encoding) as handle:
        grid = list(csv.reader(handle, **csv_opts))
    top = next((i for i, row in enumerate(grid) if sum(map(bool, row)) >= threshold), None)
    if top is None:
        return None
    header, body = grid[top], grid[top + 1 :]
    places = [i for i, name in enumerate(header) if name]
    names = []
    for n, i in enumerate(places):
        repeats = sum(header[j] == header[i] for j in places[:n])
        names.append(header[i] if not repeats else f"{header[i]}_{repeats}")
    return [
        (r, c, names[c - 1], row[i] or None)
        for r, row in enumerate(body, start=1)
        for c, i in enumerate(places, start=1)
        if i < len(row)
    ]
