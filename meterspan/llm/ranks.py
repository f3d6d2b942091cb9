"""Exact weighted ranks over any number of rows, by histograms that narrow a bracket."""

from pyspark.sql import functions as F

BINS = 1024
FEW = 50_000


def _case(column, values):
    out = F.lit(None).cast("long")
    for k, v in values.items():
        out = F.when(column == k, F.lit(int(v))).otherwise(out)
    return out


def cuts(rows, group, key, weight, wanted, low, high, slack):
    """For each group id of ``wanted`` a key such that the rows with a key at or below
    it weigh as near to ``wanted[id]`` as possible, or within ``slack`` of it.

    ``key`` is a long column within [low, high]. Returns {id: (key, weight at or
    below it, rows on the key that the cut falls on)}; key ``low - 1`` takes no row.
    Every round is one job with partial sums. The driver gets at most ``BINS`` sums
    for each open group, or ``FEW`` where so few rows are left in all brackets."""
    done, span, left = {}, {k: (low, high, 0) for k in wanted}, FEW + 1
    while span:
        width = {k: 1 if left <= FEW else max(1, -(-(b - a + 1) // BINS)) for k, (a, b, _) in span.items()}
        start, size = _case(group, {k: s[0] for k, s in span.items()}), _case(group, width)
        end = _case(group, {k: s[1] for k, s in span.items()})
        sums = {}
        inside = rows.where((key >= start) & (key <= end))
        bins = inside.groupBy(group.alias("g"), F.call_function("div", key - start, size).alias("bin"))
        for g, b, w, n in bins.agg(F.sum(weight).alias("w"), F.count("*").alias("n")).collect():
            sums.setdefault(g, []).append((b, w, n))
        following, left = {}, 0
        for k, (a, b, below) in span.items():
            at = below
            for i, w, n in sorted(sums.get(k, [])):
                if at + w > wanted[k]:
                    first, last = a + i * width[k], min(b, a + (i + 1) * width[k] - 1)
                    if w <= slack or width[k] == 1:
                        done[k] = (last, at + w, n) if at + w - wanted[k] < wanted[k] - at else (first - 1, at, n)
                    else:
                        following[k], left = (first, last, at), left + n
                    break
                at += w
            else:
                done[k] = (b, at, 0)
        span = following
    return done
