"""Parameters used when the registered queries run on the testdata fixtures.
The library defaults are the analysed pipeline's values; the fixture needs
some of them moved so that each filter actually selects (FIXTURES.md §3)."""

from ..functions import SPEND_EDGES
from ..operators.insights import InsightParams

MONTH_MIN_ORDERS = 120            # reference 50 keeps every fixture month
MONTH_MIN_REVIEWS = 50
DELIVERY_MIN_ORDERS = 50
FIXTURE_MIN_SELLER_ORDERS = 390   # every fixture seller has >= 50 delivered orders (~390 on average)
FIXTURE_SPEND_EDGES = [e * 1000 for e in SPEND_EDGES]   # fixture spend runs ~48k .. 4.1M

# states are NATION_k in the fixture; the "region" is nine of them
FIXTURE_PARAMS = InsightParams(
    focus_state="NATION_0", risk_state="NATION_1",
    region_states=[f"NATION_{k}" for k in range(9)], phase_region_states=[f"NATION_{k}" for k in range(10)], min_category_reviews=200)
