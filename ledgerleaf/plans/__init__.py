"""Whole plans: report formats as specifications, the plan from pages to holdings, and queries over the star schema."""
