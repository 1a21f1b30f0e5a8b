"""Whole steps: cleaning, the market model, the trade model, and reports."""
