"""A small independent model of replay and trimming, for comparison on tiny inputs."""

from collections import Counter
from fractions import Fraction

LIMIT = 100


def order(events):
    """(case, ts, event) rows to {case: [event, ...]}."""
    logs = {}
    for case, ts, event in sorted(events, key=lambda r: (r[1], r[2])):
        logs.setdefault(case, []).append(event)
    return logs


def trim(log, first, last):
    starts = [k for k, e in enumerate(log) if e in first]
    ends = [k for k, e in enumerate(log) if e in last]
    if not starts or not ends or ends[-1] < starts[0]:
        return None
    return log[starts[0]:ends[-1] + 1]


def _apply(path, ins, outs, pos):
    held, lost = path
    held, lost = Counter(held), list(lost)
    for place in ins:
        if not held[place]:
            lost.append((pos, place))
        else:
            held[place] -= 1
    held.update(outs)
    return +held, lost


def replay(net, log, final=()):
    """(status, detail, missing, indices, unconsumed) of a log on [(id, name, ins, outs), ...]."""
    paths = [(Counter({"p1": 1}), [])]
    for pos, event in enumerate(log):
        options = [(ins, outs) for _, name, ins, outs in net if name == event]
        if not options:
            return "unknown_event", event, [], [], []
        stay, split = [], []
        for path in paths:
            share = [Fraction(sum(not path[0][p] for p in ins), len(ins)) if ins else Fraction(0) for ins, _ in options]
            nexts = [_apply(path, ins, outs, pos) for s, (ins, outs) in zip(share, options) if s == min(share)]
            (stay if len(nexts) == 1 else split).append(nexts)
        paths = [p for family in stay + split[::-1] for p in family]
        if len(paths) > 1:
            fewest = min(len(lost) for _, lost in paths)
            unique = {}
            for held, lost in paths:
                if len(lost) == fewest:
                    unique.setdefault(tuple(sorted(held.items())), (held, lost))
            paths = list(unique.values())
            if len(paths) > LIMIT:
                return "path_explosion", str(LIMIT), [], [], []
    held, lost = Counter(paths[0][0]), list(paths[0][1])
    for place in final:
        if held[place]:
            held[place] -= 1
        else:
            lost.append((len(log), place))
    return "ok", None, [p for _, p in lost], [i for i, _ in lost], sorted(held.elements())
