"""The gold marts. Importing this package fills the registry."""

from starmill.plans import customers, orders, payments, revenue, sellers  # noqa: F401
