"""Where rows come from (collectors, inline rows, mapped tables) and where they are written."""
