"""Small retail tables with every irregularity the reports have to handle.

NULL and unknown keys, repeated dimension rows, NULL and unknown statuses,
missing and reversed timestamps, months without events, fractional seconds,
blank labels, missing and negative prices, events in the as-of month.
"""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq

STATUSES = ["Complete"] * 6 + ["Returned"] * 3
STATUSES += ["Shipped", "Processing", "Cancelled", "Lost", None]

# A few busy months far apart, the last complete month and the as-of month.
STARTS = [
    datetime(1995, 1, 3),
    datetime(1995, 2, 20),
    datetime(1995, 6, 1),
    datetime(2000, 5, 28),
    datetime(2000, 7, 30),
    datetime(2000, 12, 31, 23, 59, 59),
    datetime(2001, 5, 30),
    datetime(2001, 6, 27),
    datetime(2001, 7, 10),
    datetime(2001, 8, 1),
]

STAMP = pa.timestamp("us")
ORDERS = pa.schema(
    [("order_id", pa.int64()), ("user_id", pa.int64()), ("status", pa.string())]
    + [(f"{e}_at", STAMP) for e in ("created", "shipped", "delivered", "returned")]
    + [("num_of_item", pa.int64())]
)
ITEMS = pa.schema(
    [("id", pa.string())]
    + [(n, pa.int64()) for n in ("order_id", "user_id", "product_id")]
    + [("status", pa.string())]
    + [(f"{e}_at", STAMP) for e in ("created", "shipped", "delivered", "returned")]
    + [("sale_price", pa.decimal128(18, 2))]
)
PRODUCTS = pa.schema(
    [
        ("id", pa.int64()),
        ("name", pa.string()),
        ("category", pa.string()),
        ("cost", pa.decimal128(20, 3)),
        ("retail_price", pa.decimal128(18, 2)),
    ]
)
USERS = pa.schema([("id", pa.int64())])


def make(folder, seed: int, orders: int = 160) -> str:
    """Write the four tables as parquet and return the folder."""
    r = random.Random(seed)

    def maybe(value, chance=0.05):
        return None if r.random() < chance else value

    def later(start, days):
        if start is None or r.random() < 0.08:
            return None
        if r.random() < 0.1:
            return start
        micros = r.randint(-days * 8_640_000_000, days * 86_400_000_000)
        return start + timedelta(microseconds=micros)

    order_rows, item_rows = [], []
    for n in range(orders):
        created = maybe(r.choice(STARTS) + timedelta(seconds=r.randint(0, 86400)))
        shipped = later(created, 3)
        delivered = later(shipped or created, 5)
        status = r.choice(STATUSES)
        returned = later(delivered, 3) if status == "Returned" else None
        # A third of the orders belong to one customer.
        user = maybe(1 if r.random() < 0.33 else r.randint(1, 40))
        count = r.choice([0, 1, 1, 2, 3, 9])
        row = [n, user, status, created, shipped, delivered, returned, maybe(count)]
        order_rows += [row] * (2 if r.random() < 0.04 else 1)
        for i in range(count):
            own = [created, shipped, delivered, returned]
            if r.random() < 0.1:
                own = [maybe(t, 0.3) for t in own]
            item_rows.append(
                [
                    f"{n}-{i if r.random() > 0.03 else 0}",
                    maybe(n if r.random() > 0.05 else n + orders),
                    user if r.random() > 0.1 else maybe(r.randint(1, 60)),
                    maybe(7 if r.random() < 0.33 else r.randint(1, 40)),
                    status if r.random() > 0.1 else r.choice(STATUSES),
                    *own,
                    # Few distinct prices, so revenues tie.
                    None if r.random() < 0.08 else r.choice([50, 199, 1000, 1000, 60000, -25]),
                ]
            )
    product_rows = []
    for p in range(1, 31):
        row = [
            p,
            r.choice(["cap", "sock", " ", None, f"item {p}"]),
            r.choice(["Hats", "Hats", "Hats", "Socks", "Belts", "", None]),
            maybe(r.choice([300, 99500, 600000, -10])),
            maybe(r.choice([50, 199, 1000, 60000])),
        ]
        product_rows += [row] * (3 if r.random() < 0.2 else 1)
        if r.random() < 0.1:
            product_rows.append([p, f"renamed {p}", row[2], 1234, 999])
        if r.random() < 0.1:
            product_rows.append([p, row[1], "Moved", None, 999])
    user_rows = [[u] for u in range(1, 36) for _ in range(2 if u % 11 == 0 else 1)] + [[None]]

    def write(name, schema, rows):
        columns = []
        for i, field in enumerate(schema):
            values = [row[i] for row in rows]
            if pa.types.is_decimal(field.type):
                unit = Decimal(1).scaleb(-field.type.scale)
                values = [None if v is None else v * unit for v in values]
            columns.append(pa.array(values, field.type))
        pq.write_table(pa.Table.from_arrays(columns, schema=schema), f"{folder}/{name}.parquet")

    write("orders", ORDERS, order_rows)
    write("order_items", ITEMS, item_rows)
    write("products", PRODUCTS, product_rows)
    write("users", USERS, user_rows)
    return str(folder)
