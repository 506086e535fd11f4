"""Where frames go: CSV export, versioned tables, warehouse tables."""
