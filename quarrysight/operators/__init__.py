"""DataFrame -> DataFrame stages. None of them triggers an action."""
