"""Whole jobs: cleaning, column profile, engagement, product report."""
