"""Brute-force movement model in plain Python, for small fixtures only.

Follows the definition literally: a month grid from the global first to the
global last event month, for each customer-month the last event dated before
the next month (ties by event_id, descending), then the previous month's
values and the category.
"""

from decimal import Decimal


def month(day):
    return day.replace(day=1)


def add_month(m, k=1):
    y, mo = divmod(m.year * 12 + m.month - 1 + k, 12)
    return m.replace(year=y, month=mo + 1, day=1)


def category(cur, prev, m, fm):
    if cur == prev:
        return "No Change"
    if prev == 0 and cur > 0:
        return "New" if m == fm else "Reactivation"
    if prev > 0 and cur > prev:
        return "Expansion"
    if prev > 0 and cur < prev and cur > 0:
        return "Contraction"
    if prev > 0 and cur == 0:
        return "Churn"
    return "Inactive"


def model(events, customers, plans, last=None):
    """events: (event_id, customer_id, plan_id, event_date, amount);
    customers: {id: attrs dict}; plans: {plan_id: name}. Returns row dicts."""
    if not events:
        return []
    zero = Decimal("0.00")
    lo = month(min(e[3] for e in events))
    hi = last or month(max(e[3] for e in events))
    by_c = {}
    for e in events:
        by_c.setdefault(e[1], []).append(e)
    out = []
    for cid, evs in by_c.items():
        if cid not in customers:
            continue
        fm = month(min(e[3] for e in evs))
        m, prev, prev_plan = lo, zero, None
        first_row = True
        while m <= hi:
            if m >= fm:
                cands = [e for e in evs if e[3] < add_month(m)]
                pick = max(cands, key=lambda e: (e[3], e[0]))
                cur = pick[4] if pick[4] is not None else zero
                plan = pick[2]
                p, pp = (zero, None) if first_row else (prev, prev_plan)
                out.append(dict(
                    customer_id=cid, month_date=m, prev_mrr=p, current_mrr=cur, mrr_change=cur - p,
                    mrr_category=category(cur, p, m, fm), prev_plan_id=pp, current_plan_id=plan,
                    prev_plan_name=plans.get(pp), current_plan_name=plans.get(plan),
                    **customers[cid]))
                prev, prev_plan, first_row = cur, plan, False
            m = add_month(m)
    return out
