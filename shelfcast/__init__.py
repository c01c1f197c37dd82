"""Demand forecasting for product variants, built on Spark DataFrames and Spark ML."""
