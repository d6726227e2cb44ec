"""Medallion analytics for governed transaction data, written on the DataFrame API."""
