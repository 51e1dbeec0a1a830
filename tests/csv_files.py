"""Hand-written CSV sources for tests (written to a temp directory)."""

from __future__ import annotations

import csv
import io
import os

from ordermart.schemas import RAW_COLUMNS, RAW_FILE_OF


def write_csv(path: str, header, rows, bom=False, crlf=False) -> None:
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\r\n" if crlf else "\n")
    w.writerow(header)
    for r in rows:
        w.writerow(r)
    data = buf.getvalue().encode("utf-8")
    if bom:
        data = b"\xef\xbb\xbf" + data
    with open(path, "wb") as f:
        f.write(data)


def small_sources(tmp: str) -> dict[str, list]:
    """A tiny consistent dataset (2 customers, 3 orders) with the traps."""
    rows = {
        "customers": [
            ["c1", "u1", "01037", " Sao Paulo", "sp"],
            ["c2", "u1", "01037", "campinas ", "SP"],
            ["c3", "u2", "20000", "rio", "rj"],
        ],
        "geolocation": [
            ["01037", "-23.50", "-46.60", "sao paulo", "SP"],
            ["01037", "-23.52", "-46.62", "Sao Paulo", "sp"],
            ["20000", "-22.90", "-43.20", "rio", "RJ"],
        ],
        "orders": [
            ["o1", "c1", "delivered", "2017-11-02 10:00:00", "2017-11-02 11:00:00", "2017-11-03 00:00:00",
             "2017-11-10 10:00:00", "2017-11-08 00:00:00"],
            ["o2", "c2", "DELIVERED ", "2017-11-20 08:00:00", "", "", "2017-11-25 08:00:00",
             "2017-11-30 00:00:00"],
            ["o3", "c3", "shipped", "2017-12-01 09:00:00", "NaN", "2017-12-02 00:00:00", "",
             "2017-12-20 00:00:00"],
        ],
        "order_items": [
            ["o1", "1", "p1", "s1", "2017-11-05 00:00:00", "10.00", "2.50"],
            ["o1", "2", "p2", "s1", "2017-11-05 00:00:00", "20.005", "0"],
            ["o2", "1", "p1", "s2", "2017-11-21 00:00:00", "15.00", "1.00"],
            ["o3", "1", "p2", "s2", "2017-12-02 00:00:00", "99.99", "5.00"],
        ],
        "order_payments": [
            ["o1", "1", "credit_card", "3", "20.00"],
            ["o1", "2", "Voucher ", "1", "12.51"],
            ["o2", "1", "boleto", "1", "16.00"],
            ["o3", "1", "credit_card", "1", "104.99"],
        ],
        "order_reviews": [
            ["r1", "o1", "5", "", 'said "great"\r\nsecond line', "2017-11-11 00:00:00", "2017-11-12 00:00:00"],
            ["r2", "o1", "4", "NA", "a\\b", "2017-11-11 00:00:00", "2017-11-12 00:00:00"],
            ["r3", "o2", "2", "late", "", "2017-11-26 00:00:00", "2017-11-27 00:00:00"],
        ],
        "products": [
            ["p1", "beleza_saude", "40.0", "2.5", "", "100", "10", "", "10.005"],
            ["p2", "", "12", "300", "1", "250.5", "20", "12", "8"],
        ],
        "sellers": [
            ["s1", "01037", "sao paulo", "SP"],
            ["s2", "99999", "curitiba", "pr"],
        ],
        "product_category_translation": [
            ["beleza_saude", "health_beauty"],
        ],
    }
    for t, r in rows.items():
        write_csv(os.path.join(tmp, RAW_FILE_OF[t]), RAW_COLUMNS[t], r,
                  bom=(t == "product_category_translation"), crlf=(t == "product_category_translation"))
    return rows
