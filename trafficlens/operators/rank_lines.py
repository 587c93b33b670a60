"""The ranking rule (W5-W8) as a script over tab-separated lines: page_id,
dates, pageviews and total on the way in (the lists as JSON), the scores on
the way out. Rows whose lists are not what they should be score zero."""

import json
import math
import sys


def score(dates, views, total):
    views = [v for _, v in sorted(zip(dates, views))]
    if len(views) < 8 or total <= 0:
        return 0.0, 0.0, 0.0
    month = float(sum(views[-15:]) - sum(views[-30:-15]))
    day = float(views[-1] - views[-8]) * (1.0 + math.log(1.0 + sum(views[-8:-1])))
    return month, day, 1.0 / math.sqrt(total)


def main(lines, out):
    for line in lines:
        page, dates, views, total = line.rstrip("\n").split("\t")
        try:
            scores = score(json.loads(dates), json.loads(views), int(total))
        except (ValueError, TypeError):
            scores = 0.0, 0.0, 0.0
        out.write("\t".join([page, total, *map(repr, scores)]) + "\n")


if __name__ == "__main__":
    main(sys.stdin, sys.stdout)
