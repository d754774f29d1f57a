"""Files, warehouse tables and the star-schema adapters."""
