"""A shop of a few hand-written rows with the edge cases of the tables."""

from datetime import date
from decimal import Decimal as D

from tallyhouse.sources.schemas import SCHEMAS

TEES, CAPS, MUGS = "T-Shirts & Tops", "Headwear", "Drinkware"

PRODUCTS = [
    (1, "Tee", TEES, "T-Shirt", D("30.00"), D("10.00"), None, True),
    (2, "Cap", CAPS, "Cap", D("20.00"), D("8.00"), None, True),
    (3, "Beanie", CAPS, "Beanie", D("20.00"), D("8.00"), None, True),
]

# (order, customer, date, channel, status)
ORDERS = [
    (10, 1, date(2024, 1, 1), "Web", "COMPLETED"),
    (11, 1, date(2024, 1, 1), "Web", "RETURNED"),
    (12, 2, date(2024, 1, 3), "Marketplace", "COMPLETED"),
    (13, 2, date(2024, 1, 3), "Web", "CANCELLED"),
    (14, 3, date(2024, 1, 4), "Web", None),
]

# (item, order, product, quantity, net unit price, discount)
ITEMS = [
    (100, 10, 1, 2, D("27.00"), D("6.00")),
    (101, 10, 2, 1, D("20.00"), D("0.00")),
    (102, 11, 1, 1, D("30.00"), D("0.00")),
    (103, 12, 3, 3, D("18.00"), D("6.00")),
    (104, 13, 1, 5, D("30.00"), D("0.00")),
    (105, 14, 2, 1, D("20.00"), D("0.00")),
    (106, 99, 1, 1, D("30.00"), D("0.00")),
    (107, 12, 77, 1, D("30.00"), D("0.00")),
]

# (campaign, category, channel, spend, attributed, impressions, clicks, conversions)
CAMPAIGNS = [
    (301, TEES, "Email", D("100.00"), D("250.00"), 1000, 100, 10),
    (302, TEES, "Display", D("300.00"), D("350.00"), 3000, 100, 0),
    (303, CAPS, "Email", D("0.00"), D("50.00"), 10, 0, 0),
    (304, CAPS, "Email", None, D("50.00"), 10, 0, 0),
    (305, MUGS, "Email", D("10.00"), D("40.00"), 100, 10, 1),
]

# The handed-off forecast, three months per category, as (point, low, high).
FORECAST = {
    "Outerwear": [(6000, 5700, 6300), (5200, 4940, 5460), (4800, 4560, 5040)],
    "Headwear": [(72000, 77000, 87000), (81000, 86000, 96000), (90000, 95000, 105000)],
    "Accessories": [(-1500, -2000, -1000), (-800, -1300, -300), (-2000, -2500, -1500)],
    "Drinkware": [(8000, -32000, 48000)] * 3,
    "T-Shirts & Tops": [(20000, 19000, 21000)] * 3,
}
FORECAST_MONTHS = (date(2025, 7, 1), date(2025, 8, 1), date(2025, 9, 1))


class Shop:
    def __init__(self, spark):
        def frame(table, rows):
            return spark.createDataFrame(rows, SCHEMAS[table])

        self.products = frame("dim_product", PRODUCTS)
        self.orders = frame("fact_orders", [(o, c, d, None, ch, st, None) for o, c, d, ch, st in ORDERS])
        self.items = frame("fact_order_items", ITEMS)
        self.campaigns = frame("fact_marketing_campaigns", [
            (i, f"{cat} {i}", cat, ch, date(2024, 1, 1), date(2024, 1, 31), spend, seen, clicks, bought, earned)
            for i, cat, ch, spend, earned, seen, clicks, bought in CAMPAIGNS])
        self.forecasts = frame("fact_sales_forecast", [
            (8000 + 3 * k + m, category, FORECAST_MONTHS[m], D(p), D(lo), D(hi), "handoff_model", "forecast_desk",
             date(2025, 6, 28))
            for k, (category, months) in enumerate(FORECAST.items()) for m, (p, lo, hi) in enumerate(months)])
