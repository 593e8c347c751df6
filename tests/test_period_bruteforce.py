"""Period resolution against a plain-Python implementation of the same rules
(brute force over randomly composed questions)."""
from datetime import date, timedelta

import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from vitrine import constants as K
from vitrine.functions.formatting import word_pattern
from vitrine.operators import routing as R

REF = date(2026, 9, 27)
FRAGMENTS = ["quanto vendeu", "faturamento", "no mtd", "ytd", "ytda", "no ano", "no ano passado",
             "ontem", "anteontem", "no mês", "no mesmo", "mês atual", "hoje", "18/09/2024",
             "5.3", "31/02", "2026-09-01", "1999-12-31", "2026-02-30", "12-8-2025", "de",
             "acumulado do ano anterior", "categoria"]


def python_period(t: str):
    def hit(words):
        return any(regex.search(word_pattern(w), t) and not regex.search(word_pattern(w + " passado"), t)
                   and not regex.search(word_pattern(w + " anterior"), t) for w in words)
    iso = regex.search(R.ISO_RE, t)
    br = regex.search(R.BR_RE, t)
    if hit(K.YTD_WORDS):
        return "ytd", K.LABEL_YTD.format(yyyy=REF.year, ref=REF.isoformat()), "ok"
    if hit(K.MTD_WORDS):
        return "mtd", K.LABEL_MTD.format(mm=f"{REF.month:02d}", yyyy=REF.year, ref=REF.isoformat()), "ok"
    if hit(K.YESTERDAY_WORDS):
        return "yesterday", K.LABEL_YESTERDAY.format(day=(REF - timedelta(days=1)).isoformat()), "ok"
    if iso:
        y, m, d = iso.group(2), iso.group(3), iso.group(4)
        label = f"Data {y}-{m}-{d}"
    elif br:
        d, m, y = br.group(2), br.group(3), br.group(4) or str(REF.year)
        y_, m_, d_ = y, m.zfill(2), d.zfill(2)
        label = f"Data {d_}/{m_}/{y_}"
        y, m, d = y_, m_, d_
    else:
        return "today", K.LABEL_TODAY.format(ref=REF.isoformat()), "ok"
    try:
        date(int(y), int(m), int(d))
        ok = "ok"
    except ValueError:
        ok = "invalid_period"
    return "date", label, ok


@settings(max_examples=1, deadline=None)
@given(st.lists(st.lists(st.sampled_from(FRAGMENTS), min_size=1, max_size=5), min_size=150,
                max_size=150))
def test_resolve_period_matches_python(spark, texts):
    rows = [(i, " ".join(parts)) for i, parts in enumerate(texts)]
    df = spark.createDataFrame(rows, "q_id long, t string")
    got = {r["q_id"]: (r["kind"], r["periodo"], r["period_status"])
           for r in R.resolve_period(df, REF).collect()}
    for i, t in rows:
        assert got[i] == python_period(t), t
