"""Components of cells of long shapes, against a search."""

from lattica.operators import model


def flooded(cells):
    left, label = set(cells), {}
    while left:
        region, todo = set(), [min(left)]
        while todo:
            x, y = todo.pop()
            if (x, y) in left:
                left.remove((x, y))
                region.add((x, y))
                todo += [(x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)]
        label |= dict.fromkeys(region, "{}:{}".format(*min(region)))
    return label


def test_connected_cells_of_long_shapes(spark):
    """A line entered at its far end, a comb whose teeth meet at the far side, a winding strip, and single cells."""
    line = [(5, y) for y in range(201)] + [(4, 200)]
    comb = [(20 + 2 * i, y) for i in range(6) for y in range(12)] + [(x, 12) for x in range(20, 31)]
    strip = [(x, 2 * k) for k in range(6) for x in range(100, 120)] + [(119 if k % 2 == 0 else 100, 2 * k + 1) for k in range(5)]
    cells = line + comb + strip + [(1000 + 2 * i, i) for i in range(10)]
    got = model.connected_cells(spark.createDataFrame(cells, "x long, y long")).collect()
    assert {(r["x"], r["y"]): r["component"] for r in got} == flooded(cells) and len(got) == len(set(cells))
