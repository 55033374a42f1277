"""Hand-made order lines."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from orderloom.schema import RAW_COLUMNS

CENT = Decimal("0.01")
PRODUCTS = {
    "PROD001": ("Desk", "Furniture", "200.00", "120.00"),
    "PROD002": ("Lamp", "Furniture", "50.00", "45.00"),
    "PROD003": ("Pen", "Office", "2.50", "1.00"),
}


def line(order: str, number, day: str, customer: str, region: str, channel: str, product: str,
         quantity, discount="0.00", **changes) -> dict:
    name, category, price, cost = PRODUCTS[product]
    price = changes.pop("unit_price", price)
    cost = changes.pop("unit_cost", cost)
    revenue = (Decimal(price) * quantity * (1 - Decimal(discount))).quantize(CENT, ROUND_HALF_UP)
    total = (Decimal(cost) * quantity).quantize(CENT, ROUND_HALF_UP)
    row = {
        "transaction_id": order,
        "line_number": str(number),
        "order_date": day,
        "customer_id": customer,
        "product_id": product,
        "product_name": name,
        "product_category": category,
        "unit_price": price,
        "quantity": str(quantity),
        "discount": discount,
        "revenue": str(revenue),
        "unit_cost": cost,
        "total_cost": str(total),
        "profit": str(revenue - total),
        "customer_region": region,
        "sales_channel": channel,
    }
    return {**row, **changes}


def good_lines() -> list[dict]:
    """Three orders, six lines, two customers, three products, two channels, two years."""
    first = ("TXN0000001", "2023-01-05", "CUST00001", "North", "Online")
    second = ("TXN0000002", "2023-06-10", "CUST00002", "South", "Retail")
    third = ("TXN0000003", "2024-02-03", "CUST00001", "North", "Online")

    def of(order, number, product, quantity, discount="0.00"):
        key, day, customer, region, channel = order
        return line(key, number, day, customer, region, channel, product, quantity, discount)

    return [
        of(first, 1, "PROD001", 1, "0.10"),
        of(first, 2, "PROD003", 10),
        of(second, 1, "PROD002", 2, "0.25"),
        of(third, 1, "PROD001", 2),
        of(third, 2, "PROD002", 1),
        of(third, 3, "PROD003", 3, "0.05"),
    ]


def changed(index: int, **values) -> list[dict]:
    lines = good_lines()
    lines[index] = {**lines[index], **values}
    return lines


def frame(spark, rows: list[dict]):
    schema = ", ".join(f"{name} string" for name in RAW_COLUMNS)
    return spark.createDataFrame([tuple(row[name] for name in RAW_COLUMNS) for row in rows], schema)


def raw_frame(spark):
    return frame(spark, good_lines())
