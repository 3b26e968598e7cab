"""Weighted logistic regression in SQL: Newton steps with the linear system solved by elimination, written out.

All fits of a query run side by side, as groups ``g`` of the rows.
"""

from __future__ import annotations

STEPS = 10


def newton_ctes(rows: str, d: int, name: str, steps: int = STEPS) -> str:
    """CTEs, the last being ``{name}`` (g, b0 ... bd).

    ``rows`` yields g, y, w, c, x0 ... xd; xd is the intercept's column, all 1 or all 0.
    """
    n = range(d + 1)
    xs, bs = [f"x{i}" for i in n], [f"b{i}" for i in n]
    out = [f"{name}_r as materialized ({rows})",
           f"{name}_b0 as materialized (select g, any_value(c) as c, max(x{d}) as one, {', '.join(f'0.0::double as {b}' for b in bs)} from {name}_r group by g)"]
    for s in range(steps):
        t = f"{name}_{s}"
        z = " + ".join(f"{b} * {x}" for b, x in zip(bs, xs))
        out.append(f"{t}e as materialized (select r.g, w, r.c, y, {', '.join(xs)}, one, {', '.join(bs)}, 1 / (1 + exp(-({z}))) as p "
                   f"from {name}_r r join {name}_b{s} b on r.g = b.g)")
        ridge = lambda i: "1" if i < d else "1 - any_value(one)"
        cells = [f"any_value(c) * sum(w * p * (1 - p) * x{i} * x{j}){f' + {ridge(i)}' if i == j else ''} as h{i}_{j}" for i in n for j in n if j >= i]
        slopes = [f"any_value(c) * sum(w * (p - y) * x{i}){f' + any_value(b{i})' if i < d else ''} as r{i}" for i in n]
        out.append(f"{t}m0 as materialized (select g, {', '.join(cells + slopes)} from {t}e group by g)")
        for k in range(d):
            below = range(k + 1, d + 1)
            kept = [f"h{i}_{j}" for i in range(k + 1) for j in n if j >= i] + [f"r{i}" for i in range(k + 1)]
            cells = [f"h{i}_{j} - h{k}_{i} * h{k}_{j} / h{k}_{k} as h{i}_{j}" for i in below for j in n if j >= i]
            slopes = [f"r{i} - h{k}_{i} * r{k} / h{k}_{k} as r{i}" for i in below]
            out.append(f"{t}m{k + 1} as materialized (select g, {', '.join(kept + cells + slopes)} from {t}m{k})")
        before = f"{t}m{d}"
        for k in reversed(n):
            rest = "".join(f" - h{k}_{j} * s{j}" for j in range(k + 1, d + 1))
            out.append(f"{t}s{k} as materialized (select *, (r{k}{rest}) / h{k}_{k} as s{k} from {before})")
            before = f"{t}s{k}"
        moved = ", ".join(f"b{i} - s{i} as b{i}" for i in n)
        out.append(f"{name}_b{s + 1} as materialized (select b.g, c, one, {moved} from {name}_b{s} b join {before} using (g))")
    out.append(f"{name} as (select g, {', '.join(bs)} from {name}_b{steps})")
    return ",\n".join(out)


def auc_sql(scores: str, by: str) -> str:
    """(by, auc) of rows (by, y, score)."""
    return f"""select {by}, (sum(case when y = 1 then rk end) - sum(y) * (sum(y) + 1) / 2::double) / (sum(y)::double * sum(1 - y)) as auc from (
  select *, rank() over (partition by {by} order by score) + (count(*) over (partition by {by}, score) - 1) / 2::double as rk from ({scores})) group by {by}"""
