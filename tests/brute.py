"""Plain-Python statements of the trend and ranking rules (list slices),
used as brute-force expectations in tests."""

import math


def ratio(a, b):
    return None if b == 0 else a / b - 1.0


def daily(c):
    return [0.0] + [ratio(c[i], c[i - 1]) for i in range(1, len(c))]


def windowed_at(c, width):
    out = []
    for i in range(len(c)):
        if i > 2 * width - 1:
            out.append(ratio(sum(c[i - width:i]), sum(c[i - 2 * width:i - width])))
        else:
            out.append(0.0)
    return out


def published(c, width):
    """List as written: [0.0] + at-values when n > 13, else [0.0]."""
    return [0.0] + windowed_at(c, width) if len(c) > 13 else [0.0]


def rank(c, total):
    try:
        if total is None or total <= 0 or len(c) < 8:
            raise ValueError
        monthly = sum(c[-15:]) - 1.0 * sum(c[-30:-15])
        d = (c[-1] - c[-8]) * (1.0 + math.log(1.0 + sum(c[-8:-1])))
        e = 1.0 / math.sqrt(total)
        return monthly, d, e
    except ValueError:
        return 0.0, 0.0, 0.0


def series(n):
    """FIXTURES C2 general form."""
    return [(37 * i + n) % 11 + 1 + i for i in range(n)]
