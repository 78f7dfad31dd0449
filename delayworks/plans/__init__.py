"""Jobs composed from the operators, and the queries registered over them."""
