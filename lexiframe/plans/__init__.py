"""Whole jobs: operators in their order, with stored tables between the steps."""
