"""The warehouse tables as lazy plans."""
