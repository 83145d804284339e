"""Plans: marts, KPI reports, dashboard tiles and the end-to-end pipeline."""
