"""Writers. Executors write; nothing is collected."""
