import numpy as np

from slideloom.operators import morph, tissue as T


def kernel1d(row, sigma):
    r = int(4 * sigma + 0.5)
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return np.convolve(np.pad(row, r, mode="edge"), k / k.sum(), mode="valid")


def otsu(values):
    n, edges = np.histogram(values, 256, (values.min(), values.max()))
    at = (edges[1:] + edges[:-1]) / 2
    w1, w2 = np.cumsum(n), np.cumsum(n[::-1])[::-1]
    m1, m2 = np.cumsum(n * at) / w1, (np.cumsum((n * at)[::-1]) / w2[::-1])[::-1]
    return at[np.argmax(w1[:-1] * w2[1:] * (m1[:-1] - m2[1:]) ** 2)]


def pieces(mask):
    seen = np.zeros(mask.shape, bool)
    for start in zip(*np.nonzero(mask)):
        if seen[start]:
            continue
        todo, own = [start], []
        seen[start] = True
        while todo:
            y, x = todo.pop()
            own.append((y, x))
            for a, b in ((y - 1, x), (y + 1, x), (y, x - 1), (y, x + 1)):
                if 0 <= a < mask.shape[0] and 0 <= b < mask.shape[1] and mask[a, b] and not seen[a, b]:
                    seen[a, b] = True
                    todo.append((a, b))
        yield own


def test_tissue_mask_against_arrays(spark):
    rng = np.random.default_rng(2)
    image = rng.integers(0, 40, (48, 40))
    image[8:36, 6:30] += 900
    image[16:19, 12:15] = 3
    image[22:30, 18:26] = 0
    image[42:44, 34:36] += 5000
    rows = [("i", int(y), int(x), int(image[y, x])) for y in range(48) for x in range(40) if image[y, x] or (y + x) % 2]
    rows += rows[:5] + [("i", 99, 0, 7), ("i", 3, 3, None)]
    df = spark.createDataFrame(rows, "img string, y bigint, x bigint, v bigint")
    mask, cut = T.tissue_mask(df, 1.0, 12, 20, 48, 40)
    s = np.log1p(image.astype(float))
    s = np.apply_along_axis(kernel1d, 0, np.apply_along_axis(kernel1d, 1, s, 1.0), 1.0)
    least = otsu(s[image > 0])
    want = s > least
    for own in pieces(want):
        if len(own) <= 12:
            want[tuple(zip(*own))] = False
    for own in pieces(~want):
        edge = any(y in (0, 47) or x in (0, 39) for y, x in own)
        if not edge and len(own) <= 20:
            want[tuple(zip(*own))] = True
    assert {(r.y, r.x) for r in mask.collect()} == {(int(y), int(x)) for y, x in zip(*np.nonzero(want))}
    assert cut.first().threshold == round(float(np.expm1(least)), 6)
    assert T.tissue_mask(df.limit(0), 1.0, 12, 20, 48, 40)[0].count() == 0


def test_lower_envelope_against_all():
    rng = np.random.default_rng(4)
    for _ in range(200):
        at = np.sort(rng.choice(60, rng.integers(1, 30), replace=False)).astype(float)
        height, y = rng.integers(0, 200, len(at)).astype(float), np.arange(60.0)
        assert (morph.lower_envelope(at, height, y) == ((y[:, None] - at) ** 2 + height).min(1)).all()
