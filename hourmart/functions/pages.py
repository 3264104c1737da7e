"""Page predicates and the funnel score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Page paths the shop uses.
CART = "/cart"
PAYMENT = "/payment"
CONFIRMATION = "/confirmation"
PRODUCT_PATTERN = "/product_%"
PRODUCT_WORD = "product"
PURCHASE_STEPS = (CART, PAYMENT, CONFIRMATION)


def is_product_like(page: Column) -> Column:
    """Pattern test; ``_`` stands for any one character, so ``/product`` fails."""
    return page.like(PRODUCT_PATTERN)


def is_product_prefix(page: Column) -> Column:
    """Word test at positions 2-8; ``/product`` passes, the first character is free."""
    return F.substring(page, 2, len(PRODUCT_WORD)) == PRODUCT_WORD


def leads_to_purchase(page: Column, next_page: Column) -> Column:
    """The view is followed by a purchase step, or is itself the confirmation."""
    return next_page.isin(*PURCHASE_STEPS) | (page == CONFIRMATION)


def funnel_score(page: Column, next_page: Column) -> Column:
    """1 product to cart, 2 cart to payment, 3 payment to confirmation, else 0."""
    return (
        F.when(is_product_prefix(page) & (next_page == CART), 1)
        .when((page == CART) & (next_page == PAYMENT), 2)
        .when((page == PAYMENT) & (next_page == CONFIRMATION), 3)
        .otherwise(0)
    )
