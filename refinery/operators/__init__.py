"""DataFrame → DataFrame operators (rules, quality, CDC, history, star, measures, layout)."""
