"""Scalar rules as Column functions; nothing here touches a DataFrame."""
