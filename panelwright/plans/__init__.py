"""End-to-end compositions: the characteristics build and the portfolio build."""
