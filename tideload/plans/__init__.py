"""Jobs built from the operators: loads, calendar, warehouse, billing, appointments."""
