"""Sources and sinks: catalogue, landing (Bronze), Silver, warehouse targets."""
