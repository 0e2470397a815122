"""Fixed schemas: the nested checkpoint that comes in and the flat tables that go out."""

from __future__ import annotations

OWNER = "STRUCT<kind: STRING, address: STRING>"
OBJECT = f"STRUCT<object_id: STRING, version: BIGINT, owner: {OWNER}, object_type: STRING, previous_transaction: STRING, coin_type: STRING, balance: DECIMAL(20,0), package: STRUCT<original_id: STRING, modules: MAP<STRING, BINARY>>>"
CHANGE = f"STRUCT<object_id: STRING, input_version: BIGINT, input_digest: STRING, input_owner: {OWNER}, output_version: BIGINT, output_digest: STRING, output_owner: {OWNER}, id_operation: STRING>"
EVENT = "STRUCT<package_id: STRING, module: STRING, event_type: STRING, sender: STRING, contents: BINARY>"
COMMAND = "STRUCT<kind: STRING, package: STRING, module: STRING, function: STRING, type_arguments: ARRAY<STRING>, n1: INT, n2: INT>"
EFFECTS = f"""STRUCT<version: INT, transaction_digest: STRING, success: BOOLEAN, executed_epoch: BIGINT,
  error: STRING, error_command: INT, abort_code: DECIMAL(20,0), abort_module: STRING, abort_function: STRING,
  computation_cost: DECIMAL(20,0), storage_cost: DECIMAL(20,0), storage_rebate: DECIMAL(20,0),
  non_refundable_storage_fee: DECIMAL(20,0), gas_object_id: STRING, events_digest: STRING,
  lamport_version: BIGINT, dependencies: ARRAY<STRING>, created: ARRAY<STRING>, mutated: ARRAY<STRING>,
  unwrapped: ARRAY<STRING>, deleted: ARRAY<STRING>, unwrapped_then_deleted: ARRAY<STRING>, wrapped: ARRAY<STRING>,
  published: ARRAY<STRING>, changes: ARRAY<{CHANGE}>>"""
TRANSACTION = f"""STRUCT<position: INT, digest: STRING, sender: STRING, kind: STRING,
  gas_owner: STRING, gas_price: DECIMAL(20,0), gas_budget: DECIMAL(20,0), commands: ARRAY<{COMMAND}>,
  signatures: ARRAY<BINARY>, fallback_signatures: ARRAY<STRUCT<scheme: INT, bytes: BINARY>>, effects: {EFFECTS},
  events: ARRAY<{EVENT}>, fallback_events: ARRAY<{EVENT}>, objects: ARRAY<{OBJECT}>>"""
SUMMARY = """STRUCT<epoch: BIGINT, timestamp_ms: BIGINT, previous_digest: STRING, content_digest: STRING,
  network_total_transactions: DECIMAL(20,0), computation_cost: DECIMAL(20,0), storage_cost: DECIMAL(20,0),
  storage_rebate: DECIMAL(20,0), non_refundable_storage_fee: DECIMAL(20,0), raw: BINARY,
  next_epoch_committee: ARRAY<STRUCT<pubkey: BINARY, stake: DECIMAL(20,0)>>>"""
CHECKPOINT = f"""sequence_number BIGINT, digest STRING, summary {SUMMARY},
  signature STRUCT<epoch: BIGINT, signature: BINARY, signers: ARRAY<INT>>,
  transactions ARRAY<{TRANSACTION}>, objects ARRAY<{OBJECT}>"""

#: Bit of each table in a mask of tables. The mask is an accepted way to name tables.
TABLE_BITS = {
    "transactions": 0, "move_calls": 1, "balance_changes": 2, "object_changes": 3, "dependencies": 4, "commands": 6, "events": 10,
    "transaction_signatures": 13, "packages": 15, "package_modules": 15, "epoch_committees": 18, "coin_balances": 22,
}
TABLES = ("checkpoints", *TABLE_BITS)
#: Columns of the records, in order: the layout that sinks write. Fixed values.
LAYOUT = {
    "checkpoints": "sequence_number epoch timestamp_ms digest previous_digest content_digest total_network_transactions rolling_computation_cost rolling_storage_cost rolling_storage_rebate rolling_non_refundable_storage_fee",
    "transactions": """digest sender success tx_kind computation_cost storage_cost storage_rebate non_refundable_storage_fee checkpoint_seq timestamp_ms move_call_count epoch
      error_kind error_description error_command_index error_abort_code error_module error_function error_arg_idx error_type_arg_idx error_sub_kind error_current_size error_max_size error_coin_type error_denied_address error_object_id
      events_digest lamport_version dependency_count gas_owner gas_price gas_budget gas_object_id expiration_kind expiration_epoch expiration_min_epoch expiration_max_epoch expiration_min_ts_seconds expiration_max_ts_seconds expiration_chain expiration_nonce""",
    "move_calls": "tx_digest call_index package module function checkpoint_seq timestamp_ms",
    "balance_changes": "tx_digest checkpoint_seq address coin_type amount timestamp_ms",
    "object_changes": "tx_digest object_id change_type object_type input_version input_digest input_owner input_owner_kind output_version output_digest output_owner output_owner_kind is_gas_object previous_transaction checkpoint_seq timestamp_ms",
    "coin_balances": "tx_digest object_id owner_kind owner_id coin_type balance is_deleted checkpoint_seq timestamp_ms",
    "dependencies": "tx_digest depends_on_digest checkpoint_seq timestamp_ms",
    "commands": "tx_digest command_index kind package module function type_arguments args checkpoint_seq timestamp_ms",
    "events": "tx_digest event_seq package_id module event_type sender contents_hex checkpoint_seq timestamp_ms",
    "transaction_signatures": "tx_digest index scheme signature_hex checkpoint_seq timestamp_ms",
    "packages": "package_id version original_id module_count checkpoint_seq timestamp_ms",
    "package_modules": "package_id version module_name bytecode_hex checkpoint_seq timestamp_ms",
    "epoch_committees": "target_epoch validator_pubkey_hex stake checkpoint_seq timestamp_ms",
}
#: Columns of the records that are numbers; other quantities are decimal strings, which keep the whole range.
NUMBERS = {"move_call_count", "error_command_index", "error_arg_idx", "error_type_arg_idx", "dependency_count", "expiration_nonce", "call_index", "command_index", "event_seq", "index", "scheme", "module_count"}
#: The columns of the manifest that are stored.
MANIFEST = "epoch BIGINT, first_seq BIGINT, last_seq BIGINT, count BIGINT, zst_bytes BIGINT, zst_sha256 STRING"
