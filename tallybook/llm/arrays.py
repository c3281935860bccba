"""SQL for arrays: values that are bound to a name, and running results, in time that grows with the array."""

from __future__ import annotations

PART = 256  # elements of a running result that are built together


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def running(values: str, step: str) -> str:
    """The running result of ``step`` (of c, so far, and x) over an array of longs, each element included.

    It is built in parts of PART elements, since an array that grows is copied for each element.
    """
    start = "named_struct('at', {}, 'out', cast(array() as array<{}>))"
    inner = (f"aggregate(part, {start.format('p.at', 'bigint')}, (q, x) -> " + let("q.at", "c", let(step, "y",
             "named_struct('at', y, 'out', concat(q.out, array(y)))")) + ")")
    parts = f"transform(sequence(0, (size(vs) - 1) div {PART}), b -> slice(vs, b * {PART} + 1, {PART}))"
    walk = (f"aggregate({parts}, {start.format('0L', 'array<bigint>')}, (p, part) -> "
            + let(inner, "done", "named_struct('at', done.at, 'out', concat(p.out, array(done.out)))") + ", p -> flatten(p.out))")
    return let(values, "vs", f"if(size(vs) = 0, cast(array() as array<bigint>), {walk})")
