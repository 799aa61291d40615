"""Plans: size-checked joins, the star loader, the metric layer, reports and the full build."""
